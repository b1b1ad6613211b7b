import html
import re

import pytest
from pyspark.sql import functions as F

from salesmart.llm import html_extract as x


def article(page):
    """What the generated pages call an article: the blocks of their one article element."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)[^>]*>", inner)
    return " ".join(filter(None, (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)))


def test_query(spark, sf):
    out = {r.page_id: r for r in x.op1_html_extract(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(out) == len(pages)
    for page in pages:
        assert out[page.page_id].text == article(page.html), page.html
        assert out[page.page_id].n_chars == len(out[page.page_id].text)


def site(i, body):
    return (f"<html><head><title>t{i}</title></head><body><div class='top'><ul><li><a href=/a>Home {i}</a><li><a>B</a><li><a>C</a></ul></div>"
            f"<div id=wrap><div class='left-sidebar'>side {i}</div><div class=inner>{body}<div class=box>Same words on each page</div></div></div>"
            f"<section id=comments><p>first! {i}</p></section><div class='cookie-notice'>ok? {i}</div></body></html>")


def test_wrapper_without_article_elements():
    pages = [site(i, f"<h2>Title {i}</h2><p>Words of page {i}, which differ<p>more &amp; more {i * i}") for i in range(12)]
    wrapper = x.induce(pages)
    assert wrapper["path"][-1] == "div.inner"
    assert x.read(pages[3], wrapper) == "Title 3 Words of page 3, which differ more & more 9"
    assert x.read(pages[3], {}) .startswith("Title 3 Words of page 3")


def test_lines_on_some_pages_stay():
    pages = [site(i, f"<p>Words of page {i}</p>" + "<p>often repeated</p>" * (i % 2)) for i in range(12)]
    assert x.read(pages[5], x.induce(pages)) == "Words of page 5 often repeated"


def test_tree_matching_keeps_order():
    a, b = (x.Slim(x.parse(f"<ul>{s}</ul>")) for s in ("<li>1<li>2<p>x</p><li>4", "<li>1<li>3<li>4"))
    pairs = []
    assert x.match(a, b, pairs) == 5  # the root, the list and three items
    assert [(p.text, q.text) for p, q in pairs if p.label == "li"] == [("4", "4"), ("2", "3"), ("1", "1")]


def test_parser_edges():
    read = lambda page: x.read(page, {})
    assert read(None) == read("") == read("<html></html>") == ""
    assert read("a<b>b</b>c<br>d &lt;e&gt; &nbsp; f") == "abc d <e> f"
    assert read("<p title='a>b'>x</p><script>if (a < b) '</p>'</script><!-- <p>no</p> --><style>p{}</style>y") == "x y"
    assert read("<article><p>one<p>two<form><input>no</form><aside>no</aside></article><footer>no</footer>") == "one two"
    assert read("<p>unclosed <b>bold<p>next <!-- open") == "unclosed bold next"
    assert read("<div " + "<div>" * 5000 + "deep") == "deep"
    deep = "<html><body>" + "<div><b>" * 3000 + "deep" + "</div>" * 3000
    assert x.read(deep, x.induce([deep, deep + "x"])) == "deep"
    assert read("x" * 300_000) == "x" * 300_000
    assert read("<p>a < b and 3 <4</p>") == "a < b and 3 <4"


def test_rows(spark):
    rows = [(1, "http://h.com/a", "<p>a</p>", 1), (1, "http://h.com/a", "<p>a</p>", 2), (None, None, "<p>b</p>", 3), (2, "http://h.com/b", None, 4)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, host int").withColumn("text", F.lit("clash"))
    out = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in x.extract(docs).collect()), key=str)
    assert out == sorted([(1, "http://h.com/a", "a", 1), (1, "http://h.com/a", "a", 1), (None, None, "b", 1), (2, "http://h.com/b", "", 0)], key=str)
    assert x.extract(docs.where("false")).count() == 0


def boxes(i, kinds=("<div>", "<div>", "<div>"), halves=1):
    body = "".join(f"{kinds[-1]}" + "".join(f"<p>Words {n} of part {k} of page {i}, which differ</p>" for n in range(9)) + "</div>"
                   for k in range(halves))
    return f"<html><body>{kinds[0]}The daily masthead</div>{kinds[1]}<p>About us, on each page</p></div>{body}</body></html>"


def test_article_box_after_equal_siblings():
    for kinds in (("<div>", "<div>", "<div>"), ("<div class=row>",) * 3, ("<div class=col-3>", "<div class=col-3>", "<div class=col-9>")):
        for n in (3, 12):
            pages = [boxes(i, kinds) for i in range(n)]
            assert x.read(pages[2], x.induce(pages)) == " ".join(f"Words {k} of part 0 of page 2, which differ" for k in range(9))


def test_article_over_two_equal_siblings():
    pages = [boxes(i, halves=1 + i % 2) for i in range(12)]
    want = " ".join(f"Words {n} of part {k} of page 3, which differ" for k in range(2) for n in range(9))
    assert x.read(pages[3], x.induce(pages)) == want


def texts(spark, pages):
    rows = [(i, f"http://h.com/{i}", page) for i, page in enumerate(pages)]
    return {r.page_id: r.text for r in x.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_layouts_of_a_host_have_wrappers_of_their_own(spark):
    def page(i):
        outer, inner = [("wrap", "inner"), ("grid", "cell"), ("shell", "core")][i % 3]
        return (f"<html><body><div class={outer}><div class=top>Top {i}</div><div class={inner}><p>Words of page {i}, which differ"
                f"<p>and go on for a good while, up to {i * i}</div><div class=box>Same words everywhere</div></div></body></html>")

    out = texts(spark, [page(i) for i in range(60)])
    for i in range(60):
        assert out[i] == f"Words of page {i}, which differ and go on for a good while, up to {i * i}"


def test_copies_do_not_fill_the_draw(spark):
    out = texts(spark, [site(0, "<p>Words of page 0</p>")] * 300 + [site(i, f"<p>Words of page {i}</p>") for i in range(300, 312)])
    assert out[0] == "Words of page 0" and out[305] == "Words of page 305"


def test_lines_of_the_drawn_pages_alone_stay(spark, monkeypatch):
    monkeypatch.setattr(x, "AGREEING", 2)
    monkeypatch.setattr(x, "SAMPLE", 2)
    # A paragraph on half of the pages is in both drawn ones of some host.
    rows = [(h * 100 + i, f"http://h{h}.com/{i}", site(i, f"<p>Words of page {i}</p>" + "<p>often repeated</p>" * (i % 2)))
            for h in range(12) for i in range(30)]
    out = x.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"Words of page {r.page_id % 100}" + " often repeated" * (r.page_id % 2) for r in out)


@pytest.mark.parametrize("tag", ["form", "nav", "object", "div class=ad", "span class=ad", "div class=comment-list", "p", "b"])
def test_deep_nesting_does_not_end_the_job(tag):
    pages = [f"<body><div class=box><p>Words of page {i}, which differ</div>" + f"<{tag}>" * 3000 + f"hidden {i}" for i in range(4)]
    wrapper = x.induce(pages)
    assert x.read(pages[1], wrapper).startswith("Words of page 1, which differ")


OUT = ["comment-content", "comment-body", "comments-main", "commentlist", "cookie-text", "sidebar-content", "footer-content",
       "newsletter-body", "menu-main", "ad-content", "promo_text"]


@pytest.mark.parametrize("name", OUT)
@pytest.mark.parametrize("box", ["article", "div class=box"])
def test_marked_boxes_inside_the_article_go(name, box):
    def page(i):
        return (f"<body><div class=top>Top of {i}</div><{box}><p>Words of page {i}, which differ<p>and go on for a good while, up to {i}"
                f"<div class='{name}'>Said about {i}</div></{box.split()[0]}></body>")

    pages = [page(i) for i in range(12)]
    assert x.read(pages[3], x.induce(pages)) == "Words of page 3, which differ and go on for a good while, up to 3"


@pytest.mark.parametrize("name", ["content-with-sidebar", "post comments-open", "main-content has-sidebar", "entry-content no-ads"])
def test_boxes_that_hold_the_article_stay(name):
    pages = [f"<body><div class='{name}'><p>Words of page {i}, which differ<p>and go on, up to {i}</div></body>" for i in range(12)]
    want = "Words of page 3, which differ and go on, up to 3"
    assert x.read(pages[3], x.induce(pages)) == want and x.read(pages[3], {}) == want
