"""Main text of web pages by wrapper induction.

Some distinct pages of each layout of a host are parsed and aligned by simple tree matching. Nodes with the same text in all of them are
template, the others are slots; the deepest node that holds nearly all slot text outside menus, adverts and the like is
where the host keeps its article. That place and the template lines inside it are the host's wrapper, which all of its
pages are read with; the lines are confirmed over all pages. A page whose wrapper does not fit, or without same-host pages, is read by its marked-up parts.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import small_batches, table
from salesmart.llm.urls import split_url
from salesmart.session import materialize

#: Distinct pages aligned for each layout of a host, of these the ones all others are aligned with, and how many must agree before a line
#: inside the article counts as template. The wrapper is fitted on this sample; every page is read whole.
SAMPLE, PIVOTS, AGREEING = 12, 3, 8
#: Share of all distinct pages of a layout or a host that must have a template line.
CONFIRMED = 0.9
#: Share of the slot text that the article's node must hold.
HELD = 0.8
#: Of boxes with the same path, those with less than this share of the longest one's own text are not the article.
SHARE = 0.1
#: Elements nested more deeply than this are read as if they were not nested; their text keeps its order.
DEEPEST = 250

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
#: What is never main text.
_NEVER = frozenset(
    "head script style noscript template svg math canvas iframe object embed form button select option textarea input nav "
    "aside footer menu dialog audio video map title meta link".split())
#: Words of a class, id or role that mark what is not the article.
_MARKED = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "notices sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments discussion replies respond share "
    "sharing social related recommended newsletter subscribe signup footer header masthead popup modal pagination pager "
    "toolbar widget complementary contentinfo search hidden disclaimer".split())
#: Class names and ids of readers' comments, whatever else they say; states of a page are none.
_READERS = re.compile(r"(?:comments?|commentlist|replies|respond)(?:[-_](?!open|closed|on$|off|enabled|disabled).*)?")
#: Words that outweigh the marks outside the article: its own wrappers. Inside it only a box with most of the text may stay.
_CONTENT = frozenset("article content post entry story body text main".split())
_CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("html body table ul ol dl div section article main nav aside footer header form blockquote td th".split())


class Node:
    __slots__ = ("tag", "label", "dropped", "doubtful", "kids", "size")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.kids, self.size = tag, [], 1
        words: set[str] = set()
        self.dropped, self.doubtful, readers = tag in _NEVER, False, False
        label = tag
        if attributes.strip():
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            names = found.get("class", "").split()
            label = ".".join([tag, *sorted(re.sub(r"\d+", "", n) for n in names)])
            readers = any(_READERS.fullmatch(name.lower()) for name in (*names, found.get("id", "")))
            for value in (*names, found.get("id", ""), found.get("role", "")):
                words.update(w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()) if w)
            style = found.get("style", "").replace(" ", "").lower()
            self.dropped |= "hidden" in found or "display:none" in style or found.get("aria-hidden") == "true"
        if tag not in ("html", "body", "article", "main"):
            self.dropped |= readers or bool(words & _MARKED and not words & _CONTENT)
            self.doubtful = bool(words & _MARKED - {"header", "masthead", "banner"} and words & _CONTENT)
        self.label = label


def parse(page: str) -> Node:
    """A forgiving tree: stray end tags are ignored, left-open elements end with their parents."""
    root = Node("#")
    stack, at, end = [root], 0, len(page)

    def text(part: str) -> None:
        if part:
            stack[-1].kids.append(html.unescape(part))

    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        closes = _CLOSES.get(tag) or (None if tag in _INLINE or tag in _VOID else {"p"})
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPE and not (tag == "tr" and stack[i].tag in ("td", "th")):
                    break
        node = Node(tag, attributes)
        stack[-1].kids.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in _VOID and not attributes.rstrip().endswith("/") and (len(stack) < DEEPEST or node.dropped):
            stack.append(node)
    return root


def own_text(node: Node) -> str:
    """Text directly inside a node and its inline elements, as one block, without dropped ones."""
    parts: list[str] = []

    def walk(n: Node) -> None:
        for kid in n.kids:
            if isinstance(kid, str):
                parts.append(kid)
            elif kid.tag not in _INLINE:
                parts.append(" ")
            elif not kid.dropped:
                walk(kid)

    walk(node)
    return " ".join("".join(parts).split())


def blocks_of(node: Node) -> list[Node]:
    """Element children that are no inline elements, those inside inline elements included, unless these are dropped."""
    found = []
    for kid in node.kids:
        if isinstance(kid, Node):
            if kid.tag not in _INLINE:
                found.append(kid)
            elif not kid.dropped:
                found.extend(blocks_of(kid))
    return found


class Slim:
    """The block tree of a page, as tree matching sees it."""

    __slots__ = ("label", "text", "kids", "node", "path")

    def __init__(self, node: Node, path: tuple[str, ...] = ()):
        self.node, self.label, self.text = node, node.label, own_text(node)
        self.path = (*path, node.label)
        # What is inside a dropped element is never text; it may also be nested without bound.
        self.kids = [] if node.dropped or node.tag in _RAW else [Slim(kid, self.path) for kid in blocks_of(node)]


def match(a: Slim, b: Slim, pairs: list[tuple[Slim, Slim]]) -> int:
    """Simple tree matching: the most node pairs of equal labels that keep order and parents; they are added to
    ``pairs``."""
    if a.label != b.label:
        return 0
    pairs.append((a, b))
    if not a.kids or not b.kids:
        return 1
    n, m = len(a.kids), len(b.kids)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    inner: dict[tuple[int, int], list] = {}
    for i, x in enumerate(a.kids):
        row, above = best[i + 1], best[i]
        for j, y in enumerate(b.kids):
            weight = 0
            if x.label == y.label:
                if x.kids and y.kids:
                    inner[i, j] = found = []
                    weight = match(x, y, found)
                else:
                    weight = 1
                # Of equally many pairs, those with equal texts.
                weight += 0.001 * (x.text == y.text)
            row[j + 1] = max(row[j], above[j + 1], above[j] + weight)
    i, j = n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.extend(inner.get((i, j)) or [(a.kids[i], b.kids[j])])
    return 1 + int(best[n][m])


def _slot_mass(node: Slim, template: set[int], masses: dict[int, int]) -> int:
    if node.node.dropped:
        mass = 0
    else:
        mass = sum(_slot_mass(kid, template, masses) for kid in node.kids)
        if id(node) not in template:
            mass += len(node.text)
    masses[id(node)] = mass
    return mass


def _article(tree: Slim, template: set[int]) -> tuple[str, ...]:
    """The labels down to the deepest node with nearly all slot text, not below an article or main element."""
    masses: dict[int, int] = {}
    total = _slot_mass(tree, template, masses)
    node = tree
    while total and node.node.tag not in ("article", "main"):
        deeper = max(node.kids, key=lambda kid: masses[id(kid)], default=None)
        if deeper is None or masses[id(deeper)] < HELD * total:
            break
        node = deeper
    return node.path if total else ()


def induce(pages: list[str]) -> dict:
    """A wrapper: the path of labels to the article, (label, text) of template lines to leave out, and ``fixed``, those
    that tell boxes with the same path apart, also where few pages agree."""
    trees = [Slim(parse(page)) for page in dict.fromkeys(pages)]
    if len(trees) < 2:
        return {}
    paths, lines = [], set()
    for tree in trees[:PIVOTS]:
        same: dict[int, int] = {}
        nodes: dict[int, Slim] = {}
        for other in trees:
            if other is not tree:
                pairs: list[tuple[Slim, Slim]] = []
                match(tree, other, pairs)
                for a, b in pairs:
                    nodes[id(a)] = a
                    same[id(a)] = same.get(id(a), 0) + (bool(a.text) and a.text == b.text)
        template = {i for i, n in same.items() if n == len(trees) - 1}
        paths.append(_article(tree, template))
        lines |= {(nodes[i].label, nodes[i].text) for i in template}
    path = []
    for labels in zip(*filter(None, paths)):
        if len(set(labels)) > 1:
            break
        path.append(labels[0])
    return {"path": path, "lines": sorted(lines if len(trees) >= AGREEING else ()), "fixed": sorted(lines)} if path else {}


def _follow(node: Node, path: list[str]) -> list[Node]:
    """All nodes whose labels fit ``path``, in page order."""
    if node.label != path[0]:
        return []
    if len(path) == 1:
        return [node]
    return [found for kid in blocks_of(node) for found in _follow(kid, path[1:])]


def _own_size(node: Node, fixed: set[tuple[str, str]]) -> int:
    """The length of the text in a node that is neither template nor dropped."""
    size, queue = 0, [node]
    while queue:
        node = queue.pop()
        if not node.dropped:
            text = own_text(node)
            size += len(text) if (node.label, text) not in fixed else 0
            queue.extend(blocks_of(node))
    return size


def _boxes(tree: Node, wrapper: dict) -> list[Node]:
    """The article's nodes: where several boxes fit the path, those with own text, none far shorter than the longest."""
    found = _follow(tree, wrapper["path"]) if wrapper else []
    if len(found) > 1:
        fixed = {tuple(line) for line in wrapper.get("fixed", ())}
        sizes = [_own_size(node, fixed) for node in found]
        found = [node for node, size in zip(found, sizes) if size and size >= SHARE * max(sizes)]
    return [node for node in found if node is not tree]


def _marked_up(root: Node) -> list[Node]:
    """Outermost article elements, else main elements, else the whole page."""
    for tag in ("article", "main"):
        found: list[Node] = []
        queue = [root]
        while queue:
            node = queue.pop()
            if node.tag == tag:
                found.append(node)
            elif not node.dropped:
                queue.extend(kid for kid in reversed(node.kids) if isinstance(kid, Node))
        if found:
            return found
    return [root]


def _is_menu(node: Node) -> bool:
    """A list or box of three links or more and no other text."""
    links, other = 0, False
    queue = [node]
    while queue and not other:
        for kid in queue.pop().kids:
            if isinstance(kid, str):
                other |= any(c.isalnum() for c in kid)
            elif kid.tag == "a":
                links += 1
            else:
                queue.append(kid)
    return links >= 3 and not other


def read(page: str | None, wrapper: dict) -> str:
    """The main text of a page under a wrapper, which may be empty."""
    if not page:
        return ""
    tree = parse(page)
    roots = _boxes(tree, wrapper) or _marked_up(tree)
    lines = {tuple(line) for line in wrapper.get("lines", ())}
    blocks: list[str] = []

    def flush(parts: list[str], label: str) -> None:
        block = " ".join("".join(parts).split())
        parts.clear()
        if block and (label, block) not in lines:
            blocks.append(block)

    sizes: dict[int, int] = {}

    def whole(root: Node) -> int:
        if id(root) not in sizes:
            sizes[id(root)] = _own_size(root, set())
        return sizes[id(root)]

    for root in roots:
        article = root.tag in ("article", "main")
        # Depth first without recursion: pages may be nested very deeply.
        parts: list[str] = []
        queue: list = [(root, iter(root.kids))]
        while queue:
            node, kids = queue[-1]
            kid = next(kids, None)
            if kid is None:
                queue.pop()
                if node.tag not in _INLINE:
                    flush(parts, node.label)
            elif isinstance(kid, str):
                parts.append(kid)
            elif kid.dropped or (kid.tag == "header" and not article) or (
                    kid.doubtful and root is not tree and 2 * _own_size(kid, set()) < whole(root)) or (
                    not article and kid.tag in ("ul", "ol", "div", "table") and _is_menu(kid)):
                if kid.tag not in _INLINE:
                    flush(parts, node.label)
            elif kid.tag in _INLINE:
                queue.append((kid, iter(kid.kids)))
            else:
                flush(parts, node.label)
                queue.append((kid, iter(kid.kids)))
    return " ".join(blocks)


def layout(page: Column) -> Column:
    """A hash of the distinct labels of a page's boxes: pages of one layout have the same."""
    tags = F.regexp_extract_all(page, F.lit(r"(?i)<(?:div|section|article|main|table|td)(?:\s[^>]*)?>"), F.lit(0))
    labels = F.transform(tags, lambda t: F.concat_ws(
        ".", F.lower(F.regexp_extract(t, "^<([a-zA-Z]+)", 1)),
        F.regexp_replace(F.regexp_extract(t, r"(?i)\sclass\s*=\s*[\"']?([^\"'>]*)", 1), r"\d+", "")))
    return F.xxhash64(F.array_sort(F.array_distinct(labels)))


def line_id(label: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{label}\0{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def line_ids(page: str) -> list[int]:
    """The ids of a page's distinct lines, as the wrappers' lines have them."""
    found: set[int] = set()
    queue = [parse(page)]
    while queue:
        node = queue.pop()
        if text := own_text(node):
            found.add(line_id(node.label, text))
        if node.tag not in _RAW:
            queue.extend(blocks_of(node))
    return list(found)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, layout, wrapper as JSON) from ``pages`` (host, layout, html): one for each layout of a host, and with
    layout 0 one for the host as a whole, each of SAMPLE distinct pages or fewer, drawn by a hash of the page.

    A line that all of the drawn pages share is only template if at least CONFIRMED of all distinct pages of the layout, or
    of the host, have it. The draw is one of hashes, of which each task keeps at most SAMPLE of a group before the shuffle.
    """
    own = pages.where("host <> '' and html is not null").select("host", "layout", F.xxhash64("html").alias("page"), "html")
    distinct = materialize(own.select("host", "layout", "page").distinct())
    mixed = distinct.groupBy("host").agg((F.min("layout") < F.max("layout")).alias("mixed")).where("mixed").select("host")
    whole = F.lit(0).cast("long")
    # A host of one layout needs no wrappers by layout besides its own.
    groups = materialize(distinct.withColumn("layout", whole).union(distinct.join(mixed, "host", "left_semi")))
    order = Window.partitionBy("host", "layout").orderBy(F.xxhash64("page", F.lit(1)), "page")
    drawn = materialize(groups.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).drop("n"))
    sampled = own.drop("layout").join(drawn.select("host", "page").distinct(), ["host", "page"]).groupBy("host", "page").agg(
        F.first("html").alias("html"))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [group["host"].iloc[0]], "layout": [group["layout"].iloc[0]],
                             "wrapper": [json.dumps(induce(list(group["html"])))]})

    found = materialize(drawn.join(sampled, ["host", "page"]).groupBy("host", "layout").applyInPandas(
        learn, "host string, layout long, wrapper string"))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, k, line_id(*line)) for h, k, w in zip(batch["host"], batch["layout"], batch["wrapper"])
                    for line in json.loads(w).get("lines", ())]
            yield pd.DataFrame(rows, columns=["host", "layout", "line"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([line_ids(page) for page in batch.column("html").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("host", "layout", "page")), ids],
                                             names=["host", "layout", "page", "ids"])

    wanted = materialize(found.mapInPandas(candidates, "host string, layout long, line long").distinct())
    seen = (
        own.mapInArrow(lines, "host string, layout long, page long, ids array<long>")
        .select("host", "page", F.explode(F.array(whole, "layout")).alias("layout"), "ids")
        .select("host", "page", "layout", F.explode("ids").alias("line"))
        .join(wanted, ["host", "layout", "line"]).distinct()
        .groupBy("host", "layout", "line").agg(F.count("*").alias("n"))
    )
    sizes = groups.groupBy("host", "layout").agg(F.count("*").alias("pages"))
    confirmed = (
        seen.join(sizes, ["host", "layout"]).where(F.col("n") >= CONFIRMED * F.col("pages"))
        .groupBy("host", "layout").agg(F.collect_list("line").alias("ids"))
    )

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [json.loads(w) for w in batch["wrapper"]]
            for wrapper, ids in zip(known, batch["ids"]):
                if wrapper:
                    ids = set() if ids is None else set(ids)
                    wrapper["lines"] = [line for line in wrapper["lines"] if line_id(*line) in ids]
            yield pd.DataFrame({"host": batch["host"], "layout": batch["layout"], "wrapper": list(map(json.dumps, known))})

    return found.join(confirmed, ["host", "layout"], "left").mapInPandas(leave, "host string, layout long, wrapper string")


def both(own: str | None, host: str | None) -> dict:
    """The wrapper of a page from its layout's and its host's: the layout's path where it has one, the lines of both."""
    first, second = (json.loads(w) if w else {} for w in (own, host))
    chosen = first or second
    return {**chosen, "lines": [*first.get("lines", ()), *second.get("lines", ())]} if chosen else {}


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html, any more columns): page_id, url, text, n_chars.

    Character references are decoded, white space inside a block is one space, blocks are joined in page order by one
    space. A null or empty page, or one of markup alone, has the empty text. Repeated pages are read alike. An empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select("page_id", "url", "html", split_url(F.col("url"))[0].alias("host"), layout(F.col("html")).alias("layout"))
    # Written out, so that the joins are planned by their measured size.
    known = materialize(wrappers(pages))
    whole = known.where("layout = 0").select("host", F.col("wrapper").alias("base"))
    joined = pages.join(known.where("layout <> 0"), ["host", "layout"], "left").join(whole, "host", "left").select(
        "page_id", "url", "html", "wrapper", "base")
    page_id, url = (pages.schema[n].dataType.simpleString() for n in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, dict] = {}
        for batch in batches:
            texts = []
            for page, *key in zip(*(batch.column(n).to_pylist() for n in ("html", "wrapper", "base"))):
                if (key := tuple(key)) not in seen:
                    if len(seen) > 1000:
                        seen = {}
                    seen[key] = both(*key)
                texts.append(read(page, seen[key]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])

    return joined.mapInArrow(run, f"page_id {page_id}, url {url}, text string").withColumn(
        "n_chars", F.length("text").cast("long"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
