"""MinHash near-deduplication with sequential Bayesian verification.

Equal shingle sets become one class. Classes meet in the buckets of banded signatures. A pair is compared by batches
of signature positions and given up as soon as the posterior probability of a similarity over the threshold is below
MISS; what survives is confirmed on the full shingle sets. First each class is compared with the smallest and the
largest of its buckets, then, where that left a bucket in parts, with some class of the largest part. What is still
apart inside a bucket is compared in full, in cells of bounded size: only confirmed links that join two parts leave a
cell, so a group of n copies gives n links, not n squared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import components, small_batches, table
from salesmart.session import materialize

#: Bands of six: a pair at exactly 0.8 shares none with probability 3e-6. Batches of 32 positions are compared in turn.
BANDS, ROWS, HASHES, BATCH = 42, 6, 256, 32
PERCENT = 80
#: Probability under which a pair's posterior chance of reaching the threshold counts as none.
MISS = 1e-6
#: Classes on each side of a cell.
CELL = 256

_RANDOM = np.random.default_rng(20_240_601)
_A, _B = (_RANDOM.integers(0, 2**31, (2, HASHES), dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def shingles(text: str | None, words_each: int) -> set[bytes]:
    """Distinct shingles of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(words) < words_each:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(words_each)))))


def _minima(hashes: np.ndarray) -> np.ndarray:
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(hashes), 1024):
        x = low[at:at + 1024, None] * _A
        x += high[at:at + 1024, None] * _B
        np.minimum(best, x.min(axis=0), out=best)
    return best


def _signature(found: set[bytes]) -> tuple[bytes, bytes, np.ndarray]:
    """A digest of the whole set, the 16-bit signature, the band keys."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    hashes.sort()
    minima = _minima(hashes)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in minima[:BANDS * ROWS].reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = (keys ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(32)
    short = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), short.tobytes(), keys.view(np.int64)


def _signed(docs: DataFrame, words_each: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets, signatures, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words_each)
                digest, short, bands = _signature(found) if found else (None, None, None)
                sizes.append(len(found))
                sets.append(digest)
                signatures.append(short)
                keys.append(bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc", "n", "set_id", "sig", "bands"])

    return docs.mapInArrow(sign, "doc long, n long, set_id binary, sig binary, bands array<long>")


def _least(percent: int) -> list[int]:
    """After each batch, the fewest matches with which a pair goes on: under a uniform prior, m matches in n give
    P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    t, least = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        m, chance = -1, 0.0
        while chance < MISS:
            m += 1
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        least.append(m)
    return least


def _survivors(one: np.ndarray, others: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Which rows of ``others`` the sequential test keeps against ``one`` (a signature, or one for each row)."""
    alive = np.arange(len(others))
    matches = np.zeros(len(others), np.int64)
    for k, least in enumerate(fewest):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        mine = one[cut] if one.ndim == 1 else one[alive, cut]
        matches[alive] += (others[alive, cut] == mine).sum(axis=1)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    return alive


def _similar(a: set[bytes], b: set[bytes], percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _first_links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) among ``pairs``: each b with the most similar a by signature, if the sets confirm it."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))

    fewest = _least(percent)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column("sig_a")), _matrix(batch.column("sig_b"))
                kept = _survivors(a, b, fewest)
                matches = (a[kept] == b[kept]).sum(axis=1).astype(np.int64)
                left = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [left.column("a"), left.column("b"), pa.array(matches)], names=["a", "b", "matches"])

    likely = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .select("a", "b", "sig_a", "sig_b").mapInArrow(test, "a long, b long, matches long")
        .groupBy("b").agg(F.max_by("a", F.struct("matches", F.bitwise_not("a"))).alias("a"))
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_similar(shingles(x, words_each), shingles(y, words_each), percent)
                    for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    text = lambda s: texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}"))
    return likely.join(text("a"), "a").join(text("b"), "b").mapInArrow(confirm, "a long, b long")


class _Parts:
    """Union-find over the parts met in one cell."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x


def _cell_links(cell: list[dict], words_each: int, percent: int, fewest: list[int]) -> Iterator[tuple[int, int]]:
    """Confirmed links that join parts of one cell, of the two blocks' pairs or of one block with itself."""
    sigs = np.frombuffer(b"".join(row["sig"] for row in cell), np.uint16).reshape(-1, HASHES)
    sizes = np.array([row["n"] for row in cell])
    parts, sets = _Parts(), {}
    roots = np.array([row["part"] for row in cell])
    sides = np.array([row["side"] for row in cell])
    crossed = sides.min() != sides.max()

    def full(i: int) -> set[bytes]:
        if i not in sets:
            sets[i] = shingles(cell[i]["text"], words_each)
        return sets[i]

    for i in range(len(cell) - 1):
        rest = np.arange(i + 1, len(cell))
        fits = 100 * np.minimum(sizes[i], sizes[rest]) >= percent * np.maximum(sizes[i], sizes[rest])
        fits &= roots[rest] != roots[i]
        if crossed:
            fits &= sides[rest] != sides[i]
        rest = rest[fits]
        for j in rest[_survivors(sigs[i], sigs[rest], fewest)] if len(rest) else ():
            x, y = parts.find(int(roots[i])), parts.find(int(roots[j]))
            if x != y and _similar(full(i), full(int(j)), percent):
                parts.up[max(x, y)] = min(x, y)
                yield cell[i]["rep"], cell[int(j)]["rep"]


def _open_buckets(members: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bucket members with their part, and the buckets that hold two parts or more: their largest part, some class of
    it (another one in each bucket), its size and the number of all others."""
    placed = materialize(members.join(parts, members.rep == parts.node, "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("part")))
    sizes = placed.groupBy("key", "part").agg(
        F.count("*").alias("n"), F.min(F.col("rep").bitwiseXOR(F.col("key"))).alias("x"))
    largest = F.max(F.struct("n", "part", F.col("x").bitwiseXOR(F.col("key")).alias("leader"))).alias("g")
    buckets = sizes.groupBy("key").agg(F.sum("n").alias("m"), largest).where("m > g.n")
    return placed, materialize(buckets.select(
        "key", F.col("g.part").alias("main"), "g.leader", F.col("g.n").alias("n_main"),
        (F.col("m") - F.col("g.n")).alias("n_rest")))


def _rest_links(placed: DataFrame, buckets: DataFrame, classes: DataFrame, texts: DataFrame, words_each: int,
                percent: int) -> DataFrame:
    """Confirmed links between parts that meet in a bucket: every pair of classes of different parts is compared.

    A bucket of up to CELL classes is one cell. In a larger one the largest part's blocks meet the others' blocks, and
    the others' blocks meet each other.
    """
    blocks = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    cell = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    zero, one = F.lit(0), F.lit(1)
    own = F.pmod(F.xxhash64("rep"), F.col("of")).cast("int")
    main_blocks = F.sequence(one, F.col("n_mains"))
    other_blocks = F.sequence(zero, F.col("n_rests") - 1)
    cells = (
        F.when(F.col("n_main") + F.col("n_rest") <= CELL, F.array(cell(zero, zero, zero)))
        .when(F.col("part") == F.col("main"), F.transform(other_blocks, lambda o: cell(o, -1 - own, zero)))
        .otherwise(F.concat(
            F.transform(main_blocks, lambda g: cell(own, -g, one)),
            F.transform(other_blocks, lambda o: cell(F.least(own, o), F.greatest(own, o), own > o))))
    )
    rows = (
        placed.join(buckets, "key").withColumn("n_mains", blocks("n_main")).withColumn("n_rests", blocks("n_rest"))
        .withColumn("of", F.when(F.col("part") == F.col("main"), F.col("n_mains")).otherwise(F.col("n_rests")))
        .select("key", "rep", "part", F.explode(cells).alias("c")).select("key", "rep", "part", "c.*")
    )
    fewest = _least(percent)
    full = rows.join(classes.select("rep", "n", "sig"), "rep").join(texts, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def links() -> pa.RecordBatch:
            found = list(_cell_links(held, words_each, percent, fewest)) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                if (cell := (row["key"], row["i"], row["j"])) != at:
                    if held:
                        yield links()
                    held, at = [], cell
                held.append(row)
        if held:
            yield links()

    return full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        compare, "a long, b long")


def near_groups(docs: DataFrame, words_each: int = 5, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, any more columns): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their sets of distinct ``words_each``-word
    shingles, confirmed on the full sets; component_id is the smallest doc_id that links reach, kept says that it is
    the row's own. A null or empty text, or one of white space, has no shingles and stays alone. Rows with one
    doc_id share their links. A row without a doc_id is linked with nothing: component_id null, kept true. Equal sets
    are one class, found by a 128-bit digest of the whole set. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    signed = materialize(_signed(docs, words_each))
    own = signed.where("doc is not null and set_id is not null")
    reps = materialize(own.groupBy("set_id").agg(F.min("doc").alias("rep")))
    classes = materialize(
        own.withColumnRenamed("doc", "rep").join(reps, ["rep", "set_id"]).dropDuplicates(["rep", "set_id"]))

    members = classes.select(F.explode("bands").alias("key"), "rep")
    buckets = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    members = materialize(members.join(buckets, "key"))
    pairs = (
        members.select(F.col("low").alias("a"), F.col("rep").alias("b"))
        .union(members.select(F.col("high").alias("a"), F.col("rep").alias("b")))
    ).where("a <> b").distinct()
    met = members.select("rep").distinct()
    texts = materialize(docs.withColumnRenamed("doc", "rep").join(met, "rep", "left_semi"))

    links = materialize(_first_links(pairs, classes, texts, words_each, percent))
    parts = materialize(components(links))
    members = members.select("key", "rep")
    placed, buckets = _open_buckets(members, parts)
    pairs = placed.join(buckets, "key").where("part <> main").select(
        F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = links.union(materialize(_first_links(pairs, classes, texts, words_each, percent)))
    parts = materialize(components(links))
    placed, buckets = _open_buckets(members, parts)
    rest = materialize(_rest_links(placed, buckets, classes, texts, words_each, percent))
    # Parts are nodes of a second, smaller graph.
    name = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))
    between = rest.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    whole = materialize(components(between)).withColumnRenamed("component", "whole")

    placed = reps.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("part"))
    placed = placed.join(whole.withColumnRenamed("node", "part"), "part", "left").select(
        "set_id", F.coalesce("whole", "part").alias("component"))
    # Rows of one doc_id with different sets share their links.
    return signed.select("doc", "n", "set_id").join(placed, "set_id", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, words_each: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id, with all columns."""
    gone = near_groups(docs, words_each, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == gone["_gone"], "left_anti")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words_each=2)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0) x) y
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
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
