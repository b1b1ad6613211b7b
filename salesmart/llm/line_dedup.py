"""Line deduplication by a sharded minimal perfect hash.

Distinct line hashes with their number of documents and the smallest holder are cut into shards of a few thousand.
Each shard's repeated lines get a minimal perfect hash, which indexes arrays of fingerprints, counts and holders.
Documents send 24-byte probes, not lines, to the shards, where a probe reads one slot of the arrays; the few lines that
make up a large part of all lines sit in one broadcast shard of bounded size and send no probes at all.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import WHITE, small_batches, table
from salesmart.session import materialize

SHORTEST = 10
#: Lines per shard, and the bound on broadcast lines: one is broadcast if it makes up more than 1/HOT_LINES of all.
SHARD_LINES, HOT_LINES = 8192, 20_000
#: Stands for a null doc_id: all documents without an id count as one, which comes last.
NO_ID = 2**63 - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class LineIndex:
    """A minimal perfect hash over 128-bit line hashes and the arrays it indexes.

    Level after level, keys alone in their cell of a bit array get that cell and the others go on; a key's number is
    the number of bits before its own. n keys have the numbers 0 to n - 1.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray, holders: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.sizes: list[int] = []
        a, b = first.view(np.uint64), second.view(np.uint64)
        left = np.arange(len(a))
        while len(left):
            size = 2 * len(left) + 64
            at = self._cells(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(-(-size // 64) * 64, np.uint8)
            bits[at[alone]] = 1
            self.levels.append(np.packbits(bits, bitorder="little").view(np.uint64))
            self.sizes.append(size)
            left = left[~alone]
        self._rank()
        slot = self.slots(a, b)
        self.prints = np.empty(len(a), np.uint64)
        self.counts, self.holders = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        self.prints[slot], self.counts[slot], self.holders[slot] = b, counts, holders

    def packed(self) -> bytes:
        return pickle.dumps((self.levels, self.sizes, self.prints, self.counts, self.holders))

    @classmethod
    def unpacked(cls, blob: bytes) -> LineIndex:
        index = cls.__new__(cls)
        index.levels, index.sizes, index.prints, index.counts, index.holders = pickle.loads(blob)
        index._rank()
        return index

    @staticmethod
    def _cells(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return (_mix(a ^ _mix(b + salt)) % np.uint64(size)).astype(np.int64)

    def _rank(self) -> None:
        self.before, total = [], 0
        for words in self.levels:
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append(total + np.concatenate(([0], ones[:-1])))
            total += int(ones[-1])

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each key's number; -1 where a key met no bit, so is none of the index's. Other strangers get some number."""
        slot, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (words, size) in enumerate(zip(self.levels, self.sizes)):
            at = self._cells(a[left], b[left], level, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            there = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[there]] = self.before[level][at[there] >> 6] + below[there]
            left = left[~there]
        return slot

    def probe(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of documents (0: not in the index) and the smallest holder of each line hash."""
        a, b = first.view(np.uint64), second.view(np.uint64)
        slot = self.slots(a, b)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == b[known]
        counts, holders = np.zeros(len(a), np.int64), np.full(len(a), NO_ID)
        counts[known], holders[known] = self.counts[slot[known]], self.holders[slot[known]]
        return counts, holders


def _key(line: str) -> bytes | None:
    line = line.strip(WHITE)
    return line.encode("utf-8", "surrogatepass").lower() if len(line) >= SHORTEST else None


def _hash(key: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(key)
    return (value >> 64) - 2**63, (value & (2**64 - 1)) - 2**63


_PROBES = "first long, second long, doc long"


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct line of each document."""
    for batch in batches:
        rows = [
            (*_hash(key), NO_ID if doc is None else doc)
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()) if text
            for key in {_key(line) for line in text.split("\n")} - {None}
        ]
        arrays = np.array(rows, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["first", "second", "doc"])


def _index_shard(group: pd.DataFrame) -> pd.DataFrame:
    index = LineIndex(*(group[c].to_numpy(np.int64) for c in ("first", "second", "n", "holder")))
    return pd.DataFrame({"shard": [group["shard"].iloc[0]], "blob": [index.packed()]})


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, the shard's arrays first; out go (doc, first) of the lines a document loses."""
    shard, index = None, None
    for batch in batches:
        blobs = batch.column("blob")
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        first, second, docs = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in
                               ("first", "second", "doc"))
        is_blob = np.array(blobs.is_valid())
        cuts = np.flatnonzero(is_blob | np.concatenate(([True], shards[1:] != shards[:-1])))
        lost = np.zeros(len(shards), bool)
        for start, end in zip(cuts, [*cuts[1:], len(shards)]):
            if is_blob[start]:
                shard, index = shards[start], LineIndex.unpacked(blobs[int(start)].as_py())
                start += 1
            if shards[start:end].size and shard == shards[start]:
                counts, holders = index.probe(first[start:end], second[start:end])
                lost[start:end] = (counts > 1) & (holders != docs[start:end])
        yield pa.RecordBatch.from_arrays([pa.array(docs[lost]), pa.array(first[lost])], names=["doc", "first"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any more columns) with ``text`` reduced to the lines that stay, and ``_lines``:
    n_lines before dropping and n_dropped.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Keys of at least 10 code points
    in two documents or more stay only in the smallest doc_id that holds them, there with all their lines. A null or
    empty text is one empty line. Rows with one doc_id are one document, so are all rows without a doc_id, which come
    last. An empty table gives an empty result. ``docs`` may have any columns but one named ``_lines``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    probes = materialize(texts.mapInArrow(_probes, _PROBES))
    keys = materialize(probes.groupBy("first", "second").agg(
        F.count("*").alias("n"), F.min("doc").alias("holder"), F.max("doc").alias("last")).where("holder < last")
        .drop("last"))
    total = probes.count()
    shards = -(-total // SHARD_LINES) or 1
    with_shard = F.pmod("first", F.lit(shards)).alias("shard")
    is_hot = F.col("n") * HOT_LINES > total
    hot_rows = keys.where(is_hot).toPandas()  # fewer than HOT_LINES rows, since their counts add up to at most total
    hot = spark.sparkContext.broadcast(
        LineIndex(*(hot_rows[c].to_numpy(np.int64) for c in ("first", "second", "n", "holder"))))
    arrays = keys.where(~is_hot).select("*", with_shard).groupBy("shard").applyInPandas(
        _index_shard, "shard long, blob binary")

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(c).to_numpy() for c in ("first", "second"))
            yield batch.filter(pa.array(hot.value.probe(first, second)[0] == 0))

    empty = F.lit(None)
    mixed = arrays.select("shard", "blob", *(empty.cast("long").alias(c) for c in ("first", "second", "doc"))).union(
        probes.mapInArrow(cold, _PROBES).select(
            with_shard, empty.cast("binary").alias("blob"), "first", "second", "doc"))
    lost = (
        mixed.repartition("shard").sortWithinPartitions("shard", F.col("blob").isNull())
        .mapInArrow(_answer, "doc long, first long")
        .groupBy("doc").agg(F.collect_set("first").alias("_lost"))  # at most the lines of one document
    )
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    joined = docs.withColumn("_doc", ids).join(lost.withColumnRenamed("doc", "_doc"), "_doc", "left")
    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for doc, text, lost in zip(*(batch.column(c).to_pylist() for c in ("_doc", "text", "_lost"))):
                lines = (text or "").split("\n")
                keys = [_key(line) for line in lines]
                hashes = [None if key is None else _hash(key) for key in keys]
                pairs = np.array([h or (0, 0) for h in hashes], np.int64).reshape(-1, 2)
                n, holders = hot.value.probe(pairs[:, 0].copy(), pairs[:, 1].copy())
                out = (n > 1) & (holders != doc)
                if lost:
                    out |= np.isin(pairs[:, 0], np.array(lost, np.int64))
                out &= np.array([key is not None for key in keys])
                texts.append("\n".join(line for line, gone in zip(lines, out) if not gone))
                counts.append({"n_lines": len(lines), "n_dropped": int(out.sum())})
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64())]))],
                names=[*names, "_lines"])

    return joined.mapInArrow(keep, f"{kinds}, _lines struct<n_lines: long, n_dropped: long>")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_lines.n_lines").alias("n_lines"), F.col("_lines.n_dropped").alias("n_dropped"),
                       F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) x
), k AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key, min(doc_id) AS holder FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.doc_id, k.line, k.pos, r.holder IS NOT NULL AND r.holder <> k.doc_id AS gone FROM k LEFT JOIN r ON r.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
