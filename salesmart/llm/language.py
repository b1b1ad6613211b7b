"""Language identification by unigram piece probabilities, summed over all segmentations.

For each language every piece of a fixed public vocabulary has a probability. A word's probability is the sum over all
ways to cut it into pieces, by the forward algorithm; a text's is the product over its words. The probabilities come
from all learning rows: word counts by language, then rounds of expected piece counts by forward and backward sums.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import held_out, small_batches, table
from salesmart.llm.vocabulary import PIECES, pieces
from salesmart.session import materialize

#: Runs of letters, lower-cased, are words; longer ones are scored in stretches of so many letters.
STRETCH = 32
_WORD = re.compile(r"[^\W\d_]{1,%d}" % STRETCH)
ROUNDS = 2
#: Probability of a letter that no piece holds, and how many observations the prior over pieces weighs.
UNKNOWN, PRIOR = 1e-7, 200.0
#: Words a task remembers at once, when scoring beside the most frequent ones, which come with the model.
REMEMBERED, COUNTED, FREQUENT = 200_000, 400_000, 60_000
SPACE = "▁"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def letter_pieces(path: str) -> list[str]:
    """The vocabulary's lower-case letter pieces, with or without the word mark, in order of rank."""
    found = (p for p, _, kind in pieces(path) if kind == "text")
    return [p for p in found if p == p.lower() and (re.fullmatch(SPACE + r"?[^\W\d_]+", p) or p == SPACE)]


class Lattice:
    """All pieces at all places of some words, and sums over all paths through them."""

    def __init__(self, automaton: ahocorasick.Automaton, words: list[str], unknown: int):
        ends_of_words = np.cumsum([len(w) + 2 for w in words])  # with the mark and the gap
        text = "\n".join(SPACE + w for w in words)
        found = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
        found = np.stack([found[:, 0], found[:, 1] >> 32, found[:, 1] & (2**32 - 1)], axis=1)
        word = np.searchsorted(ends_of_words, found[:, 0], side="right")
        begin = np.concatenate(([0], ends_of_words[:-1]))
        end = found[:, 0] - begin[word] + 1
        self.lengths = np.array([len(w) + 1 for w in words])
        self.width = int(self.lengths.max()) + 1 if words else 1
        # A letter, or the mark, without a piece of its own is the unknown piece.
        single = np.zeros((len(words), self.width), bool)
        one = found[:, 1] == 1
        single[word[one], end[one]] = True
        need = ~single & (np.arange(self.width) >= 1) & (np.arange(self.width) <= self.lengths[:, None])
        w, e = np.nonzero(need)
        self.word = np.concatenate([word, w])
        self.end = np.concatenate([end, e])
        self.size = np.concatenate([found[:, 1], np.ones(len(w), np.int64)])
        self.piece = np.concatenate([found[:, 2], np.full(len(w), unknown)])
        order = np.lexsort((self.size, self.end))
        for name in ("word", "end", "size", "piece"):
            setattr(self, name, getattr(self, name)[order])
        key = self.end * 64 + self.size
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        self.groups = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]  # one end and size: a word once at most

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all ways to each place; ``weight`` holds each piece occurrence's probability, or a row of them."""
        alpha = np.zeros((len(self.lengths), self.width, *weight.shape[1:]))
        alpha[:, 0] = 1
        for g in self.groups:
            e, s = int(self.end[g.start]), int(self.size[g.start])
            alpha[self.word[g], e] += alpha[self.word[g], e - s] * weight[g]
        return alpha

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[np.arange(len(self.lengths)), self.lengths]

    def expected(self, weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each piece occurrence, how often it is used on average when its word occurs ``counts`` times."""
        alpha = self.forward(weight)
        beta = np.zeros_like(alpha)
        beta[np.arange(len(self.lengths)), self.lengths] = 1
        for g in reversed(self.groups):
            e, s = int(self.end[g.start]), int(self.size[g.start])
            beta[self.word[g], e - s] += beta[self.word[g], e] * weight[g]
        share = alpha[self.word, self.end - self.size] * weight * beta[self.word, self.end]
        return share * (counts / self.totals(alpha))[self.word]


class LanguageModel:
    """``chances[piece, language]``; the last piece is the unknown letter. ``prior`` holds each language's share,
    ``frequent`` common words, which every task would meet again, and ``frequent_scores`` theirs."""

    def __init__(self, names: list[str], vocabulary: list[str], chances: np.ndarray, prior: np.ndarray):
        self.names, self.vocabulary, self.chances, self.prior = names, vocabulary, chances, prior
        self.frequent: list[str] = []
        self.frequent_scores = np.zeros((0, len(names)))

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for i, piece in enumerate(self.vocabulary):
            found.add_word(piece, len(piece) << 32 | i)
        found.make_automaton()
        return found

    def word_scores(self, automaton: ahocorasick.Automaton, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        lattice = Lattice(automaton, words, len(self.vocabulary))
        return np.log(lattice.totals(lattice.forward(self.chances[lattice.piece])))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())],
                names=["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > COUNTED:
            yield from flush()
    yield from flush()


def train(docs: DataFrame, path: str = PIECES, rounds: int = ROUNDS) -> LanguageModel:
    """Learn from the rows of ``docs`` (text, lang) with a lang. To the driver come only piece probabilities: as many
    as the vocabulary has pieces for each language. Without such rows the model knows no language."""
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.where("lang is not null").select("lang", "text")
    shares = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names, vocabulary = sorted(shares), letter_pieces(path)
    start = np.append(1 / np.arange(10, 10 + len(vocabulary)), UNKNOWN)
    start[:-1] /= start[:-1].sum()
    chances = np.repeat(start[:, None], len(names), axis=1)
    prior = np.array([shares[n] for n in names], float)
    model = LanguageModel(names, vocabulary, chances, np.log(prior / prior.sum()) if names else prior)
    if not names:
        return model
    words = materialize(known.mapInArrow(_count_words, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = shared.value
            automaton = model.automaton()
            total = np.zeros(model.chances.T.shape)
            place = {name: i for i, name in enumerate(model.names)}
            for batch in batches:
                if batch.num_rows:
                    lattice = Lattice(automaton, batch.column("word").to_pylist(), len(model.vocabulary))
                    lang = np.array([place[x] for x in batch.column("lang").to_pylist()])[lattice.word]
                    counts = batch.column("n").to_numpy().astype(float)
                    np.add.at(total, (lang, lattice.piece),
                              lattice.expected(model.chances[lattice.piece, lang], counts))
            lang, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(piece), pa.array(total[lang, piece])],
                                             names=["lang", "piece", "x"])

        sums = (words.mapInArrow(expect, "lang long, piece long, x double")
                .groupBy("lang", "piece").agg(F.sum("x").alias("x")).toPandas())
        counts = np.zeros_like(chances)
        counts[sums["piece"].to_numpy(int), sums["lang"].to_numpy(int)] = sums["x"]
        counts = counts[:-1] + PRIOR * start[:-1, None]
        chances = np.vstack([counts / counts.sum(axis=0), np.full((1, len(names)), UNKNOWN)])
        model = LanguageModel(names, vocabulary, chances, model.prior)
    common = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    model.frequent = [r["word"] for r in common]
    model.frequent_scores = model.word_scores(model.automaton(), model.frequent)
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language's posterior probability.

    A null text, one without a letter, and any text under a model without languages are ``und`` with score 0. Whole
    texts count, whatever their length; equal scores go to the first name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        automaton = model.automaton()
        fixed = len(model.frequent)
        memo = dict(zip(model.frequent, range(fixed)))
        table = model.frequent_scores
        for batch in batches:
            texts = [words_of(text) for text in batch.column("text").to_pylist()]
            if len(memo) > REMEMBERED + fixed:
                memo, table = dict(zip(model.frequent, range(fixed))), table[:fixed]
            new = list({w for words in texts for w in words if w not in memo}) if model.names else []
            rows = []
            for at in range(0, len(new), 20_000):
                part = new[at:at + 20_000]
                memo.update(zip(part, range(len(memo), len(memo) + len(part))))
                rows.append(model.word_scores(automaton, part))
            table = np.concatenate([table, *rows])
            langs, scores = [], []
            for words in texts:
                if not words or not model.names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                ids = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
                total = table[ids].sum(axis=0) + model.prior
                best = int(total.argmax())
                langs.append(model.names[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(score, f"{schema}, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.where("not held_out"))
    return predict(docs.select("doc_id", "held_out", "text"), model).drop("text")
