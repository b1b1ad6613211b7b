"""N-gram Jaccard join filtered by prefixes under several global token orders.

A set's prefix under an order is so long that two sets that are similar enough must share a token of their prefixes,
whatever the order. Each order here sorts tokens by their count in one row of a count-min table over the corpus, rare
ones first, so the orders agree that shared passages come last and differ in everything else. Candidates come from the
inverted index of the first order's prefixes; they must share prefix tokens, early enough for the overlap to be in
reach, under all orders; what is left is confirmed on the full sets.

Equal sets are one class. In every list of the index, classes are first compared with its ends, then with some class of
its largest linked part; what is still apart is compared in full, in cells of bounded size, by sizes and positions
alone, so that only rows of a few numbers are repeated and only pairs that every filter passes fetch texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import components, discard, small_batches, table, written
from salesmart.llm.near_dedup import shingles

PERCENT = 80
#: Token orders, and the counters of each one's row of the count-min table: 3 MB in all, at any size of the corpus.
ORDERS, COUNTERS = 3, 1 << 18
#: Counters that travel together.
SLICE = 4096
#: Classes on each side of a cell.
CELL = 256

_RANDOM = np.random.default_rng(20_240_612)
_PLACES = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROWS = _RANDOM.integers(0, 2**63, ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokens(text: str | None, words_each: int) -> np.ndarray:
    """The distinct shingles of ``near_dedup.shingles`` as ascending 64-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    each = min(words_each, len(words))
    found = np.full(len(words) - each + 1, each, np.uint64)
    for i in range(each):
        found += hashes[i:i + len(found)] * _PLACES[i]
    return np.unique(_mixed(found))


def _counters(found: np.ndarray, order: int) -> np.ndarray:
    return (found * _ROWS[order] >> np.uint64(64 - (COUNTERS - 1).bit_length())).astype(np.int64)


def _probe(n: int, percent: int) -> int:
    """How many first tokens of a set of n can be the first one shared with any similar set."""
    return n + percent * n // -100 + 1


def _index(n: Column, percent: int) -> Column:
    """The same, shared with a similar set that is no smaller."""
    return n - F.ceil(2 * percent * n / (100 + percent)) + 1


def prefixes(found: np.ndarray, counts: np.ndarray, percent: int) -> list[np.ndarray]:
    """The prefix of a set (ascending hashes) under the order of each row of ``counts``."""
    length = _probe(len(found), percent)
    result = []
    for order in range(len(counts)):
        # Count first, then a hash of the token; the stable sort leaves equal keys in the order of the hashes.
        key = counts[order][_counters(found, order)].astype(np.uint64) << np.uint64(32)
        key |= (found * _ROWS[order - 1]) >> np.uint64(32)
        result.append(found[np.argsort(key, kind="stable")[:length]])
    return result


def _sized(docs: DataFrame, words_each: int) -> DataFrame:
    """(doc, n, set_id) for every row, and (slice, counters): each task's counts of its documents' tokens."""
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    names = ["doc", "n", "set_id", "slice", "counters"]

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ORDERS, COUNTERS), np.uint32)
        for batch in batches:
            found = [tokens(text, words_each) for text in batch.column("text").to_pylist()]
            sizes = [len(f) for f in found]
            sets = [hashlib.blake2b(f.tobytes(), digest_size=16).digest() if len(f) else None for f in found]
            if found:
                met = np.concatenate(found)
                for order in range(ORDERS):
                    counts[order] += np.bincount(_counters(met, order), minlength=COUNTERS).astype(np.uint32)
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(v, t) for v, t in zip((sizes, sets, none, none), types[1:]))], names=names)
        slices = counts.reshape(-1, SLICE)
        used = np.flatnonzero(slices.any(axis=1))
        none = [None] * len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip((none, none, none, used.tolist(), [slices[i].tobytes() for i in used]), types)],
            names=names)

    return docs.mapInArrow(size, "doc long, n long, set_id binary, slice int, counters binary")


def _counts(sized: DataFrame) -> np.ndarray:
    """The count-min table, which has a fixed size; counts stop at the largest 32-bit number."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counters in zip(batch.column("slice").to_pylist(), batch.column("counters").to_pylist()):
                total = sums.setdefault(at, np.zeros(SLICE, np.uint64))
                total += np.frombuffer(counters, np.uint32)
        top = np.uint64(2**32 - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.minimum(s, top).astype(np.uint32).tobytes() for s in sums.values()], pa.binary())],
            names=["slice", "counters"])

    parts = sized.where("slice is not null").select("slice", "counters").repartition("slice").mapInArrow(
        add, "slice int, counters binary")
    counts = np.zeros((ORDERS * COUNTERS // SLICE, SLICE), np.uint32)
    for row in parts.collect():
        counts[row["slice"]] = np.frombuffer(row["counters"], np.uint32)
    return counts.reshape(ORDERS, COUNTERS)


def _indexed(docs: DataFrame, words_each: int, percent: int, counts) -> DataFrame:
    """(doc, set_id, n, prefix): every set's prefix under the first order."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        for batch in batches:
            ids, sets, sizes, firsts = [], [], [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                found = tokens(text, words_each)
                if len(found) and doc is not None:
                    ids.append(doc)
                    sets.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    sizes.append(len(found))
                    firsts.append(prefixes(found, known[:1], percent)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(firsts, pa.list_(pa.int64()))], names=["doc", "set_id", "n", "prefix"])

    return docs.mapInArrow(index, "doc long, set_id binary, n long, prefix array<long>")


def _headed(texts: DataFrame, words_each: int, percent: int, counts) -> DataFrame:
    """(rep, text, n, heads): 32-bit fingerprints of the prefix under each order, in its order."""
    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        for batch in batches:
            sizes, heads = [], []
            for text in batch.column("text").to_pylist():
                found = tokens(text, words_each)
                sizes.append(len(found))
                heads.append([(p >> np.uint64(32)).astype(np.uint32).tobytes() for p in prefixes(found, known, percent)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("text"), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.binary()))],
                names=["rep", "text", "n", "heads"])

    return texts.mapInArrow(head, "rep long, text string, n long, heads array<binary>")


def _needed(n_a, n_b, percent: int):
    """The overlap of two similar sets of these sizes."""
    return -(percent * (n_a + n_b) // -(100 + percent))


def in_reach(heads_a: list[bytes], heads_b: list[bytes], n_a: int, n_b: int, percent: int) -> bool:
    """Whether under every order the prefixes share a token, early enough for the overlap that is needed.

    Behind a first shared token at places i and j there are at most n_a - i - 1 and n_b - j - 1 more. Equal
    fingerprints of different tokens only let more pairs through.
    """
    need = _needed(n_a, n_b, percent)
    for a, b in zip(heads_a, heads_b):
        both, i, j = np.intersect1d(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), return_indices=True)
        if not len(both) or np.minimum(n_a - i, n_b - j).max() < need:
            return False
    return True


def _links(pairs: DataFrame, texts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that pass the filters of all orders and then the comparison of the full sets."""
    def side(s: str, *columns: str) -> DataFrame:
        return texts.select(F.col("rep").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in columns))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (batch.column(c).to_pylist() for c in ("heads_a", "heads_b", "n_a", "n_b"))
            good = [in_reach(*row, percent) for row in zip(*cells)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                x, y = shingles(x, words_each), shingles(y, words_each)
                both = len(x & y)
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Written before texts are fetched, so that the shuffles of prefixes and those of texts need not be kept at once.
    likely = written(
        pairs.join(side("a", "n", "heads"), "a").join(side("b", "n", "heads"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .mapInArrow(screen, "a long, b long").distinct()
    )
    return likely.join(side("a", "text"), "a").join(side("b", "text"), "b").mapInArrow(confirm, "a long, b long")


def _best(pairs: DataFrame) -> DataFrame:
    """For each b the a that it meets most often."""
    return pairs.where("a <> b").groupBy("b", "a").agg(F.count("*").alias("times")).groupBy("b").agg(
        F.max_by("a", F.struct("times", F.bitwise_not("a"))).alias("a")).select("a", "b")


def _apart(members: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index with each class's part, and the lists that hold several parts: the largest one, some class of it,
    its size and the number of all others."""
    placed = written(members.join(parts, members.rep == parts.node, "left").select(
        "token", "rep", "n", "place", F.coalesce("component", "rep").alias("part")))
    sizes = placed.groupBy("token", "part").agg(
        F.count("*").alias("m"), F.min(F.col("rep").bitwiseXOR(F.col("token"))).alias("some"))
    lists = sizes.groupBy("token").agg(F.sum("m").alias("m"), F.max(F.struct("m", "part", "some")).alias("main"))
    return placed, written(lists.where("m > main.m").select(
        "token", F.col("main.part").alias("main"), F.col("main.some").bitwiseXOR(F.col("token")).alias("leader"),
        F.col("main.m").alias("n_main"), (F.col("m") - F.col("main.m")).alias("n_rest")))


def _cell_pairs(cell: dict[str, np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of different parts in a cell whose sizes are near enough and whose shared token comes early enough."""
    n, left, part, rep, side = (cell[c] for c in ("n", "left", "part", "rep", "side"))
    crossed = side.min() != side.max()
    for i in range(len(n) - 1):
        rest = slice(i + 1, None)
        good = 100 * np.minimum(n[i], n[rest]) >= percent * np.maximum(n[i], n[rest])
        good &= np.minimum(left[i], left[rest]) >= _needed(n[i], n[rest], percent)
        good &= part[rest] != part[i]
        if crossed:
            good &= side[rest] != side[i]
        for j in np.flatnonzero(good) + i + 1:
            yield int(rep[i]), int(rep[j])


def _rest_pairs(placed: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Every pair of classes of different parts that meet in a list, unless sizes or places rule it out.

    A list of up to CELL classes is one cell; in a longer one blocks of the largest part meet blocks of the others, and
    those each other.
    """
    def blocks(size: str) -> Column:
        return F.ceil(F.col(size) / CELL).cast("int")

    def cell(i: Column, j: Column, side: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    zero, is_main = F.lit(0), F.col("part") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(is_main, blocks("n_main")).otherwise(blocks("n_rest"))).cast("int")
    others = F.sequence(zero, blocks("n_rest") - 1)
    with_main = F.transform(F.sequence(F.lit(1), blocks("n_main")), lambda g: cell(own, -g, F.lit(1)))
    among = F.transform(others, lambda o: cell(F.least(own, o), F.greatest(own, o), own > o))
    cells = (
        F.when(F.col("n_main") + F.col("n_rest") <= CELL, F.array(cell(zero, zero, zero)))
        .when(is_main, F.transform(others, lambda o: cell(o, -1 - own, zero)))
        .otherwise(F.concat(with_main, among)))
    rows = placed.join(lists, "token").select(
        "token", "rep", "n", (F.col("n") - F.col("place")).alias("left"), "part", F.explode(cells).alias("c")).select(
        "token", "c.*", "rep", "n", "left", "part")
    names = ("rep", "n", "left", "part", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        at = None

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            ends = np.array(pairs, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], names=["a", "b"])

        def pairs_held() -> list[tuple[int, int]]:
            return list(_cell_pairs({c: np.concatenate([h[c] for h in held]) for c in names}, percent)) if held else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("token", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            columns = {c: batch.column(c).to_numpy() for c in names}
            found = []
            for start, end in zip(cuts, cuts[1:]):
                if (key := tuple(keys[:, start])) != at:
                    found += pairs_held()
                    held, at = [], key
                held.append({c: v[start:end] for c, v in columns.items()})
            yield out(found)
        yield out(pairs_held())

    return rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(
        compare, "a long, b long").distinct()


def similar_groups(docs: DataFrame, words_each: int = 5, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, any more columns): doc_id, n_shingles, component_id.

    A document's set holds its distinct ``words_each``-word shingles of words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased;
    fewer words are one shingle. Documents link when 100 * intersection >= percent * union, confirmed on the full sets;
    component_id is the smallest doc_id that links reach. A null or empty text, or one of white space, has no shingles
    and is linked with nothing. Rows with one doc_id share their links; a row without a doc_id has none, and
    component_id null. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sized = written(_sized(docs, words_each))
    counts = spark.sparkContext.broadcast(_counts(sized))
    sized = sized.where("slice is null").select("doc", "n", "set_id")
    reps = written(sized.where("doc is not null and set_id is not null").groupBy("set_id").agg(F.min("doc").alias("rep")))
    indexed = _indexed(docs, words_each, percent, counts).withColumnRenamed("doc", "rep")
    classes = indexed.join(reps, ["rep", "set_id"], "left_semi").dropDuplicates(["rep", "set_id"])
    index = written(classes.select("rep", "n", F.posexplode("prefix").alias("place", "token")))
    # A list is of use when it holds two classes and one of them could be the smaller of a pair. Lists are written before
    # they meet their members, so that the shuffles of the two largest steps need not be kept at once.
    lists = written(index.groupBy("token").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high"),
        F.max((F.col("place") < _index(F.col("n"), percent)).cast("int")).alias("first")
    ).where("low < high and first = 1").drop("first"))
    members = written(index.join(lists, "token"))
    discard(index)
    met = members.select("rep").distinct()
    texts = written(_headed(
        docs.withColumnRenamed("doc", "rep").join(met, "rep", "left_semi"), words_each, percent, counts))

    ends = members.select(F.explode(F.array("low", "high")).alias("a"), F.col("rep").alias("b"))
    links = written(_links(_best(ends), texts, words_each, percent))
    parts = written(components(links))
    members = members.drop("low", "high")
    placed, lists = _apart(members, parts)
    leaders = placed.join(lists, "token").where("part <> main").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    links = links.union(written(_links(_best(leaders), texts, words_each, percent)))
    parts = written(components(links))
    placed, lists = _apart(members, parts)
    rest = written(_links(_rest_pairs(placed, lists, percent), texts, words_each, percent))
    # Parts are the nodes of a second, smaller graph.
    name = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))
    between = rest.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    whole = written(components(between)).withColumnRenamed("component", "whole")
    groups = (
        reps.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select("set_id", F.coalesce("component", "rep").alias("part"))
        .join(whole.withColumnRenamed("node", "part"), "part", "left")
        .select("set_id", F.coalesce("whole", "part").alias("component"))
    )
    return sized.join(groups, "set_id", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, counted; components by reachability.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE list_slice(ws, i, i + 4) END AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0) x
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM e
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
