"""URL filters: host and path rules first, gradient-boosted trees over lexical features for all other URLs.

DataFrame functions and Spark's own trees only. The trees learn from the URLs that rules judge.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import table
from salesmart.session import materialize

#: Verdict, host, path of the rules.
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
#: The trees are fitted on at most about so many distinct judged URLs, drawn by a hash of the URL and weighted by their rows.
SAMPLE = 20_000

FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters",
            "query_length", "marks", "longest_word", "fragment", "secure", "suffix1", "suffix2"]
_BIG, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _BIG, _SMALL)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (url) with host, path, rule and rule_verdict. A rule fits its host and all subdomains if the path starts
    with the rule's; the longest wins, of equal lengths the first as text. Meant for some hundreds of rules."""
    host, path = split_url(F.col("url"))
    known = F.array(*(F.struct(F.lit(-len(h + p)).alias("order"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
                               F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules))
    fit = F.filter(known, lambda r: (
        (F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"]))
    ) & F.startswith(F.col("path"), r["path"]))
    marked = pages.withColumn("host", host).withColumn("path", path).withColumn("_rule", F.array_min(fit))
    return marked.withColumn("rule", F.col("_rule.rule")).withColumn("rule_verdict", F.col("_rule.verdict")).drop("_rule")


def _suffix(n: int) -> Column:
    labels = F.split("host", r"\.")
    return F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n))


def suffix_statistics(judged: DataFrame) -> tuple[dict[int, DataFrame], float]:
    """For the last label and the last two: (suffix, known), the share of blocked ones among the URLs with each suffix, drawn
    towards the share among all, which is returned beside. ``judged`` holds distinct URLs and how many rows each has; every
    suffix has its row, so the tables are joined by measured size."""
    total, blocked = judged.agg(F.sum("weight"), F.sum(F.col("label") * F.col("weight"))).first()
    share = (blocked or 0.0) / max(total or 0, 1)
    found = {}
    for n in (1, 2):
        known = (F.sum(F.col("label") * F.col("weight")) + 10 * share) / (F.sum("weight") + 10)
        found[n] = materialize(judged.groupBy(_suffix(n).alias(f"_suffix{n}")).agg(known.alias(f"_known{n}")))
    return found, share


def with_features(pages: DataFrame, statistics: tuple[dict[int, DataFrame], float]) -> DataFrame:
    """``pages`` (url, host, path) with the columns of FEATURES, prefixed by ``f_``."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda pattern: F.length(url) - F.length(F.regexp_replace(url, pattern, ""))
    share = lambda c: (size - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(
        F.transform(F.array_distinct(F.regexp_extract_all(url, F.lit("(?s)."), F.lit(0))),
                    lambda c: -share(c) * F.log2(share(c))), F.lit(0.0), lambda a, b: a + b)
    words = F.transform(F.split(url, "[^A-Za-z0-9]+"), lambda w: F.length(w))

    known, share_of_all = statistics
    for n in known:
        pages = pages.withColumn(f"_suffix{n}", _suffix(n)).join(known[n], f"_suffix{n}", "left")
    statistic = lambda n: F.coalesce(f"_known{n}", F.lit(share_of_all))

    values = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")), "labels": F.size(F.split("host", r"\.")),
        "digit_ratio": count("[0-9]") / size, "entropy": entropy,
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")), "query_length": F.length(query),
        "marks": count(r"[-_.%~+]"), "longest_word": F.array_max(words), "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": F.startswith(url, F.lit("https")).cast("int"), "suffix1": statistic(1), "suffix2": statistic(2),
    }
    return pages.withColumns({f"f_{name}": values[name].cast("double") for name in FEATURES})


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"f_{name}" for name in FEATURES], outputCol="_features")


def train(pages: DataFrame, sample: int = SAMPLE) -> tuple[tuple, GBTClassificationModel | str]:
    """Suffix statistics of all URLs that a rule judges, and trees fitted on at most about ``sample`` distinct ones, each
    weighted by its rows; where the rules only give one verdict, that verdict, and ``allow`` where they give none."""
    judged = materialize(pages.where("rule_verdict is not null").groupBy(
        "url", "host", "path", (F.col("rule_verdict") == "block").cast("double").alias("label")
    ).agg(F.count("*").cast("double").alias("weight")))
    statistics = suffix_statistics(judged)
    sizes = {r["label"]: r["n"] for r in judged.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return statistics, "block" if 1.0 in sizes else "allow"
    share = min(1.0, sample / sum(sizes.values()))
    drawn = judged.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(share * 1_000_000))
    ready = materialize(with_features(drawn, statistics))
    if ready.select("label").distinct().count() < 2:
        return statistics, "block" if sizes[1.0] > sizes[0.0] else "allow"
    trees = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="weight", maxIter=15, maxDepth=4, stepSize=0.3,
                          subsamplingRate=0.8, seed=11)
    return statistics, trees.fit(_assembler().transform(ready.coalesce(4)).select("_features", "label", "weight"))


def judge(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` (page_id, url, any more columns): page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the trees. Equal URLs get
    equal verdicts. An empty table gives an empty result.
    """
    marked = with_rule(pages.select("page_id", "url"), rules)
    statistics, model = train(marked, sample)
    if isinstance(model, str):
        return marked.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(model)).alias("verdict"))
    scored = model.transform(_assembler().transform(with_features(marked, statistics)))
    own = F.when(F.col("prediction") == 1, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
