from pyspark.sql import functions as F

from salesmart.llm import urls


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fit, default=(0, None, None))
    return host, path, rule, verdict


def test_rules(spark):
    hosts = ["com", "x.com", "example.com", "www.example.com", "a.www.example.com", "notexample.com", "net", "a.NET", "x.org", "É.com", ""]
    paths = ["", "/", "/en/", "/en/x", "/en", "/es/1", "/fr/", "//", "/a://b"]
    tails = ["", "?q=/en/", "#/en/", "?a#b"]
    given = [f"{s}{h}{p}{t}" for s in ("http://", "HTTPS://", "") for h in hosts for p in paths for t in tails] + [None, "", "://", "a\nb://x.com/\n?"]
    docs = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("rule", F.lit("x"))
    out = {r.page_id: r for r in urls.judge(docs).collect()}
    assert len(out) == len(given)
    for i, url in enumerate(given):
        host, path, rule, verdict = brute(url)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), url
        assert out[i].verdict == verdict if verdict else out[i].verdict in ("allow", "block")


def test_learns_from_judged_urls(spark):
    rows = [(i, f"http://s{i % 7}.example.org/a/{i}") for i in range(200)] + [
        (1000 + i, f"http://s{i % 7}.example.net/spam/x/y/z/{i}{i}{i}{i}?p=1&q=2&r=3") for i in range(200)]
    rules = [("allow", "s1.example.org", "/"), ("allow", "s2.example.org", "/"), ("block", "s1.example.net", "/"), ("block", "s3.example.net", "/")]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()
    right = sum((r.verdict == "block") == (r.page_id >= 1000) for r in out)
    assert right > 0.95 * len(out)


def test_a_hot_url_is_one_row_of_the_sample(spark, monkeypatch):
    # A URL with most rows: the trees get distinct URLs, within the bound, and its rows as a weight.
    rows = [(i, f"http://s{i % 7}.example.{'net' if i % 2 else 'org'}/a/{i}") for i in range(3000)]
    rows += [(10_000 + i, "http://s1.example.net/hot") for i in range(6000)]
    rules = [("allow", "example.org", "/"), ("block", "example.net", "/")]
    fitted, fit = [], urls.GBTClassifier.fit
    monkeypatch.setattr(urls.GBTClassifier, "fit", lambda self, df: fitted.append((df.count(), df.agg(F.max("weight")).first()[0])) or fit(self, df))
    statistics, _ = urls.train(urls.with_rule(spark.createDataFrame(rows, "page_id long, url string"), rules), sample=4000)
    assert fitted == [(3001, 6000.0)]
    urls.train(urls.with_rule(spark.createDataFrame(rows, "page_id long, url string"), rules), sample=300)
    assert 200 < fitted[1][0] < 400
    known, share = statistics
    assert share == 7500 / 9000
    counts = {r[0]: r[1] for r in known[1].collect()}
    assert counts["net"] == (7500 + 10 * share) / 7510 and counts["org"] == 10 * share / 1510


def test_rare_suffixes_have_statistics(spark):
    rows = [(i, f"http://h{i}.org/") for i in range(3000)] + [(5000, "http://spam.rare/")]
    judged = urls.with_rule(spark.createDataFrame(rows, "page_id long, url string"), [("allow", "org", "/"), ("block", "rare", "/")])
    known, share = urls.train(judged)[0]
    assert known[2].count() == 3001
    assert known[1].where("_suffix1 = 'rare'").first()["_known1"] == (1 + 10 * share) / 11


def test_empty_and_one_sided(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty).count() == 0
    one = spark.createDataFrame([(None, "http://a.com/x"), (1, None), (1, None)], "page_id long, url string")
    assert sorted(r.verdict for r in urls.judge(one).collect()) == ["allow"] * 3


def test_query(spark, sf):
    out = urls.op8_url_filters(spark, sf).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        host, path, rule, verdict = brute(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
