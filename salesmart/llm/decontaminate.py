"""Benchmark decontamination by a broadcast set of test n-grams.

Words are lower-cased (A-Z) runs without ASCII space, punctuation or control characters. Documents are scanned where
they lie: words become numbers of the benchmark's vocabulary, windows are hashed by numpy, hits in the hash set are
verified word by word. Nothing of a document is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

from salesmart.llm.common import small_batches, table
from salesmart.session import materialize

WINDOW = 10
#: Characters of benchmark text in one broadcast set (about 20 bytes of set each). A larger benchmark is cut into
#: blocks of whole items and the documents are scanned once for each, so the broadcast never grows.
BLOCK_CHARS = 20_000_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Per byte of UTF-8: letters in lower case, what ends a word as a space, all else as it is.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Grams:
    """The normalised n-grams of some items: vocabulary, window hashes by length, and the windows themselves."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], list[str]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in words_of(text)]
            size = min(window, len(ids))
            for gram in {tuple(ids[i:i + size]) for i in range(len(ids) - size + 1)} if size else ():
                self.windows.setdefault(gram, []).append(item_id)
        self.hashes = {
            size: np.unique(np.array([self._hash(np.array(g, np.uint64))[0] for g in self.windows if len(g) == size]))
            for size in {len(gram) for gram in self.windows}
        }

    @staticmethod
    def _hash(ids: np.ndarray, size: int | None = None) -> np.ndarray:
        """A hash for each window of ``size`` ids."""
        size = len(ids) if size is None else size
        total = np.zeros(len(ids) - size + 1, np.uint64)
        for k in range(size):
            total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[k:k + len(total)] * np.uint64(0xD6E8FEB86659FD93))
            total ^= total >> np.uint64(29)
        return total

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside an occurring window, and the items whose windows occur."""
        get = self.vocabulary.get
        ids = np.fromiter((get(word, 0) for word in words), np.uint64, len(words))
        hit, items = np.zeros(len(words), bool), set()
        for size, known in self.hashes.items():
            if len(ids) < size:
                continue
            foreign = np.concatenate(([0], np.cumsum(ids == 0)))
            starts = np.flatnonzero(foreign[size:] == foreign[:-size])  # windows of benchmark words only
            if not len(starts):
                continue
            found = self._hash(ids, size)[starts]
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for start in starts[known[at] == found]:
                owners = self.windows.get(tuple(ids[start:start + size].tolist()))
                if owners:
                    hit[start:start + size] = True
                    items.update(owners)
        return hit, items


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items as text id and text, in blocks of bounded size, one after the other."""
    items = materialize(benchmark.where("text is not null").select(F.col("item_id").cast("string"), "text"))
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((str(item_id), text))
        size += len(text)
    yield block


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def _mark(text: str | None, old: dict | None, grams: Grams) -> dict:
    words = words_of(text)
    hit, items = grams.hits(words)
    if old:
        items.update(old["items"])
        for span in old["words"]:
            hit[span["start"]:span["end"]] = True
    spans, chars = _spans(hit), []
    if spans:
        places = [m.span() for m in _WORD.finditer(text)]
        chars = [(places[a][0], places[b - 1][1]) for a, b in spans]
    return {
        "n_words": len(words), "items": sorted(items),
        "words": [{"start": a, "end": b} for a, b in spans], "chars": [{"start": a, "end": b} for a, b in chars],
    }


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_HITS = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("words", _SPANS), ("chars", _SPANS)])


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with a column ``_hits``: n_words, items (ids as text, sorted), and the hit spans in words and in code
    points, ends exclusive.

    An item with fewer words than ``window`` is one window; one without words, or with a null text, none. A null
    or empty document has no words. Rows that repeat an item_id are one item; items without an id are called ``None``.
    An empty benchmark hits nothing. ``docs`` needs ``text`` and may have any more columns, but none named ``_hits``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = StructType([*docs.schema.fields, StructField("_hits", from_arrow_type(_HITS))])
    marked = docs
    for number, block in enumerate(_blocks(benchmark, block_chars)):
        grams = spark.sparkContext.broadcast(Grams(block, window))
        if number:
            marked = materialize(marked)

        def scan(batches: Iterator[pa.RecordBatch], grams=grams) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pydict() if "_hits" in batch.schema.names else None
                texts = batch.column("text").to_pylist()
                hits = pa.array([_mark(text, rows["_hits"][i] if rows else None, grams.value)
                                 for i, text in enumerate(texts)], _HITS)
                names = [name for name in batch.schema.names if name != "_hits"]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), hits], names=[*names, "_hits"])

        marked = marked.mapInArrow(scan, schema)
    return marked


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see ``find_hits``)."""
    hits = find_hits(docs.select("doc_id", "text"), benchmark, window, block_chars)
    n_hit = F.aggregate("_hits.words", F.lit(0).cast("long"), lambda total, x: total + x.end - x.start)
    return hits.select(
        "doc_id", F.col("_hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_hits.items", ","), 256).alias("items_sha256"),
        (F.size("_hits.words") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark content: ``documents`` leaves out every document with a hit, ``spans`` cuts the hit
    words out of the text, from the first to the last character of a span, and leaves the rest as it was."""
    hits = find_hits(docs, benchmark, window)
    if remove == "documents":
        return hits.where(F.size("_hits.words") == 0).drop("_hits")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    start = F.lit(0).cast("long")
    cut = F.aggregate(
        "_hits.chars", F.struct(F.lit("").alias("kept"), start.alias("at")),
        lambda s, x: F.struct(
            F.concat(s.kept, F.substr("text", (s.at + 1).cast("int"), (x.start - s.at).cast("int"))).alias("kept"),
            x.end.alias("at")),
        lambda s: F.concat(s.kept, F.substr("text", (s.at + 1).cast("int"))),
    )
    return hits.withColumn("text", F.when(F.size("_hits.chars") > 0, cut).otherwise(F.col("text"))).drop("_hits")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), g AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS gram
  FROM (SELECT item_id, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM b WHERE len(ws) > 0) x
), p AS (
  SELECT doc_id, s.size, i, array_to_string(ws[i:i + s.size - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM g) t WHERE len(ws) >= size) s
), hit AS (
  SELECT doc_id, item_id, i, p.size FROM p JOIN g ON g.gram = p.gram AND g.size = p.size
), n AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hit) x GROUP BY doc_id
), m AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) x GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""
