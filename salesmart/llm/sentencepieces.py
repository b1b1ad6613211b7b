"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi search.

The automaton reads a stretch once; at each place it reports every piece that ends there, longest first along its output
links, and each relaxes the best score of that place. Ids are those of the vocabulary with the highest sum of scores.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import small_batches, table
from salesmart.llm.vocabulary import PIECES, pieces

SPACE = "▁"
#: How far below the lowest score an unknown letter counts, as SentencePiece has it.
PENALTY = 10.0
#: Stretches a task remembers, and the longest worth it.
REMEMBERED, MEMORABLE = 400_000, 32


class Encoder:
    """Spaces become the word mark and every text starts with one; letters without a piece become their UTF-8 bytes.

    A word mark in the text itself is encoded as bytes too, so that decoding gives every text back.
    """

    def __init__(self, table: list[tuple[str, float, str]]):
        self.bytes = {}
        self.automaton = ahocorasick.Automaton()
        self.spelled = [b""] * len(table)
        inside: set[str] = set()
        pairs: set[tuple[str, str]] = set()
        scores = [score for _, score, kind in table if kind == "text"]
        self.unknown = min(scores, default=0.0) - PENALTY
        for i, (piece, score, kind) in enumerate(table):
            if kind == "text":
                self.automaton.add_word(piece, (len(piece), score, i))
                self.spelled[i] = piece.replace(SPACE, " ").encode()
                pairs.update(zip(piece, piece[1:]))
                inside.update(piece if len(piece) > 1 else "")
            elif kind == "byte":
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
        if len(self.bytes) < 256:
            raise ValueError("the vocabulary needs a piece for every byte")
        self.automaton.make_automaton()
        # Stretches can be solved one by one where no piece holds both sides of a cut: before a word mark that follows
        # something else, around a line end, and between a letter and a punctuation mark.
        marks = {c for c in string.punctuation if not any(a.isalpha() and b == c for a, b in pairs)}
        if any(a != SPACE and b == SPACE for a, b in pairs):
            self.stretch = re.compile(r"(?s).+")
        else:
            line = "" if "\n" in inside else r"\n"
            marks = "".join(map(re.escape, sorted(marks)))
            more = rf"(?:[^{SPACE}{line}{marks}]+|(?<![^\W\d_])[{marks}])*" if marks else rf"[^{SPACE}{line}]*"
            self.stretch = re.compile(rf"{SPACE}*[^{SPACE}{line}]{more}|{SPACE}+|\n")
        self.memo: dict[str, bytes] = {}

    def best(self, text: str) -> bytes:
        """The ids of one stretch as 32-bit integers."""
        n = len(text)
        score, back, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        at, single, reached = 1, False, -1e300
        for end, (size, own, i) in self.automaton.iter(text):
            while at <= end:  # places without a piece of one letter
                if not single and (unknown := score[at - 1] + self.unknown) > reached:
                    reached, back[at], piece[at] = unknown, at - 1, -1
                score[at] = reached
                at, single, reached = at + 1, False, -1e300
            single |= size == 1
            if (sum_ := score[end + 1 - size] + own) > reached:
                reached, back[at], piece[at] = sum_, end + 1 - size, i
        while at <= n:
            if not single and (unknown := score[at - 1] + self.unknown) > reached:
                reached, back[at], piece[at] = unknown, at - 1, -1
            score[at] = reached
            at, single, reached = at + 1, False, -1e300
        ids: list[int] = []
        while n:
            if piece[n] >= 0:
                ids.append(piece[n])
            else:
                ids.extend(self.bytes[b] for b in reversed(text[n - 1].encode("utf-8", "surrogatepass")))
            n = back[n]
        return np.array(ids[::-1], np.int32).tobytes()

    def _plain(self, text: str) -> bytes:
        out = []
        for stretch in self.stretch.findall(text):
            ids = self.memo.get(stretch)
            if ids is None:
                ids = self.best(stretch)
                if len(stretch) <= MEMORABLE:
                    if len(self.memo) >= REMEMBERED:
                        self.memo.clear()
                    self.memo[stretch] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        mark = np.array([self.bytes[b] for b in SPACE.encode()], np.int32).tobytes()
        parts = (" " + text).split(SPACE)
        return np.frombuffer(mark.join(self._plain(p.replace(" ", SPACE)) if p else b"" for p in parts), np.int32)

    def decode(self, ids) -> str:
        """The text of some ids; control pieces are silent, bytes that are no UTF-8 become replacement characters."""
        found = b"".join(map(self.spelled.__getitem__, ids))
        return found.removeprefix(b" ").decode("utf-8", "replace")


def _mapped(docs: DataFrame, path: str, columns: dict[str, str], fill) -> DataFrame:
    """``docs`` with more columns, name to type; ``fill`` makes them of an encoder and a batch."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces(path))  # the vocabulary: a fixed size, whatever the documents
    names = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        *(f"{name} {kind}" for name, kind in columns.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *fill(encoder, batch)],
                                             names=[*names, *columns])

    return docs.mapInArrow(run, schema)


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in found], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def encode(docs: DataFrame, path: str = PIECES, column: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in ``column``, which ``docs`` must not have. A null or empty text has none."""
    return _mapped(docs, path, {column: "array<int>"},
                   lambda encoder, batch: [_lists([encoder.encode(t) for t in batch.column("text").to_pylist()])])


def decode(docs: DataFrame, path: str = PIECES, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in ``column``; no ids, or null, give the empty text."""
    return _mapped(docs, path, {column: "string"}, lambda encoder, batch: [pa.array(
        [encoder.decode(x.as_py() or ()) for x in batch.column(ids)], pa.string())])


def encode_and_decode(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """``docs`` with ``ids`` and, decoded from these, ``decoded``, in one go over the texts."""
    def both(encoder: Encoder, batch: pa.RecordBatch) -> list[pa.Array]:
        ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
        return [_lists(ids), pa.array([encoder.decode(x.tolist()) for x in ids], pa.string())]

    return _mapped(docs, path, {"ids": "array<int>", "decoded": "string"}, both)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, the decoded text's hash, and whether it is the text."""
    return encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
