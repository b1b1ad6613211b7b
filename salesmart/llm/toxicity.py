"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are rates over the whole text: words of a general list of insults and of a lexicon learned from the labelled
rows, as written and after undoing disguises, their nearness to words for "you", capitals, punctuation, and disguised
words themselves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import held_out, small_batches, table
from salesmart.session import materialize

#: A classifier is fitted on at most so many labelled rows, drawn by a hash of the id.
SAMPLE = 20_000
THRESHOLD = 0.3
#: The learned lexicon: words and word beginnings (of STEMS letters, written with a star) whose log odds are at least ODDS
#: even two standard errors down, in at least SUPPORT toxic texts and one in LEAST of them. That bounds what is broadcast:
#: it cannot be more than LEAST times the units of an average toxic text.
SUPPORT, LEAST, ODDS, STEMS = 5, 2_000, 1.0, (4, 5, 6, 7)
#: Bits of the filter that finds labelled documents before any text is shuffled: 8 MB, whatever the number of labels.
#: Far more labels than a tenth of that let more texts through to the exact join.
FILTER_BITS, FILTER_HASHES = 1 << 26, 3

#: Common insults and swear words, by language.
INSULTS = frozenset(
    # English
    "idiot idiots moron morons stupid dumb fool loser losers scum trash garbage pathetic worthless disgusting clown "
    "clowns jerk creep pig bastard bitch asshole shit shitty crap fuck fucking fucker damn cunt dick prick whore slut "
    "retard retarded imbecile vermin filth filthy ugly hate kill die coward liar freak lunatic psycho "
    # German
    "idiotin dumm dummkopf trottel depp arschloch scheiße scheisse hurensohn abschaum versager blödmann widerlich "
    # French
    "idiote imbécile crétin connard connasse salaud salope merde putain pute abruti débile ordure nul "
    # Spanish
    "idiota estúpido estúpida imbécil tonto tonta mierda puta puto cabrón gilipollas pendejo basura asqueroso"
    .split()
)
#: Words for "you" and "your".
YOU = frozenset(
    "you your yours yourself ya u ur du dich dir dein deine deiner euch euer sie tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros vuestro".split()
)
#: Letters that digits and signs stand for.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
                          "!": "i", "|": "i", "€": "e", "+": "t"})
NEAR = 6

FEATURES = [
    "insult_rate", "insult_any", "learned_rate", "learned_any", "learned_strength", "learned_sum", "near_you_rate", "you_rate",
    "hidden_rate", "hidden_any", "disguised_rate", "masked_rate", "capital_rate", "shouted_rate", "exclaimed_rate",
    "asked_rate", "run_rate", "stretched_rate", "mark_rate", "word_length", "log_words",
]

_EDGE = "\"'`.,:;!?()[]{}<>|…“”‘’«»¡¿-–—*_~"
_SHOUT = re.compile(r"\b[A-ZÀ-Þ]{3,}\b")
_RUN = re.compile(r"[!?]{2,}")
_STRETCH = re.compile(r"(\w)\1\1+")
_MASK = re.compile(r"\w[*#]+\w|\w\*{2,}")
_ODD = re.compile(r"[0-9@$!|€+*.\-_]|(\w)\1\1")


def weight(word: str, learned: dict[str, float]) -> float:
    """The strongest entry of the learned lexicon for a word or its beginnings; 0 without one."""
    best = learned.get(word, 0.0)
    for k in STEMS:
        if len(word) > k:
            best = max(best, learned.get(word[:k] + "*", 0.0))
    return best


def plain(token: str) -> str:
    """A token in lower case without its disguise: look-alike signs, marks between letters, stretched letters."""
    token = token.lower().strip("\"'`,:;?()[]{}<>…“”‘’«»¡¿").rstrip("!?.,:;")
    token = _STRETCH.sub(r"\1", token.translate(DISGUISE))
    return re.sub(r"[\W\d_]", "", token)


class Featurizer:
    """Values of a text for FEATURES. What depends on one token alone is kept in a table, for a bounded number of them."""

    REMEMBERED = 300_000
    SINGLE = ["insult", "known", "weight", "you", "hidden", "disguised", "masked", "shouted", "run", "stretched", "upper",
              "alpha", "length", "single"]

    def __init__(self, learned: dict[str, float]):
        self.learned = learned
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.SINGLE)), np.float32)

    def token(self, token: str) -> tuple[float, ...]:
        """One value for each of SINGLE."""
        word = token.rstrip(".,")
        if word.isalpha() and (word.islower() or word[1:].islower()) and not _STRETCH.search(word):
            upper, word = not word[0].islower(), word.lower()
            strong = weight(word, self.learned)
            return (word in INSULTS, strong > 0, strong, word in YOU, 0, 0, 0, 0, 0, 0, upper, len(word), len(word),
                    len(token) == 1)
        word = token.lower().strip(_EDGE)
        insult, strong = word in INSULTS, weight(word, self.learned)
        upper, alpha = sum(map(str.isupper, token)), sum(map(str.isalpha, token))
        hidden = disguised = False
        if len(token) > 2 and not insult and not strong and _ODD.search(token):
            shown = plain(token)
            if shown != word:
                disguised = alpha > 0
                hidden = shown in INSULTS or weight(shown, self.learned) > 0
        return (insult, strong > 0, strong, word in YOU, hidden, disguised, len(_MASK.findall(token)),
                len(_SHOUT.findall(token)), len(_RUN.findall(token)), len(_STRETCH.findall(token)), upper, alpha, len(word), len(token) == 1)

    def _places(self, tokens: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > self.REMEMBERED:
            self._forget()
            memo = self.memo
        new = [t for t in set(tokens) if t not in memo]
        if new:
            first = len(memo)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[first:first + len(new)] = [self.token(t) for t in new]
            memo.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))

    def _spelled(self, tokens: list[str], single: np.ndarray) -> int:
        """How many rows of at least four single letters spell a word of the lists."""
        found = 0
        for row in np.split(single, np.flatnonzero(np.diff(single) > 1) + 1):
            if len(row) >= 4:
                shown = plain("".join(tokens[row[0]:row[-1] + 1]))
                found += shown in INSULTS or weight(shown, self.learned) > 0
        return found

    def __call__(self, text: str | None) -> list[float]:
        """A null or empty text, and one of white space, has zeros."""
        tokens = text.split() if text else []
        if not tokens:
            return [0.0] * len(FEATURES)
        places = self._places(tokens)
        rows = self.table[places]
        total = dict(zip(self.SINGLE, rows.sum(axis=0, dtype=np.float64).tolist()))
        col = self.SINGLE.index
        distinct = self.table[np.unique(places), col("weight")]
        hidden = total["hidden"]
        if total["single"] >= 4:
            hidden += self._spelled(tokens, np.flatnonzero(rows[:, col("single")]))
        aimed, n, chars = 0, len(tokens), len(text)
        if total["you"] and total["insult"] + hidden:
            you = np.flatnonzero(rows[:, col("you")])
            bad = np.flatnonzero(rows[:, col("insult")] + rows[:, col("hidden")])
            after = you[np.minimum(np.searchsorted(you, bad), len(you) - 1)]
            before = you[np.maximum(np.searchsorted(you, bad) - 1, 0)]
            aimed = int((np.minimum(np.abs(after - bad), np.abs(bad - before)) <= NEAR).sum())
        return [
            total["insult"] / n, min(total["insult"], 5.0), total["known"] / n, min(total["known"], 5.0),
            float(distinct.max()), min(float(distinct.sum()), 40.0), aimed / n, total["you"] / n, hidden / n,
            min(hidden, 5.0), total["disguised"] / n, total["masked"] / n, total["upper"] / max(1.0, total["alpha"]),
            total["shouted"] / n, text.count("!") / chars, text.count("?") / chars, total["run"] / n,
            total["stretched"] / n, sum(map(text.count, ".,;:-\"'")) / chars, total["length"] / n, math.log1p(n),
        ]


def with_features(docs: DataFrame, learned: dict[str, float]) -> DataFrame:
    """``docs`` (text and any more columns, none of them named as a feature) with the columns of FEATURES."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(learned)
    names = [n for n in docs.columns if n != "text"]
    schema = ", ".join([*(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names),
                        *(f"{n} double" for n in FEATURES)])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer(shared.value)
        for batch in batches:
            rows = np.array([featurizer(t) for t in batch.column("text").to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *(pa.array(c) for c in rows.reshape(-1, len(FEATURES)).T)],
                names=[*names, *FEATURES])

    return docs.mapInArrow(compute, schema)


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Words of ``texts`` (text, label; every text once) and their beginnings, by their log odds between toxic and other
    texts, two standard errors down."""
    words = F.transform(F.split(F.lower("text"), r"\s+"),
                        lambda w: F.regexp_replace(w, r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", ""))
    units = F.flatten(F.transform(F.array_distinct(words), lambda w: F.array(
        w, *(F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS))))
    words = (
        texts.select("label", F.explode(F.array_distinct(F.array_compact(units))).alias("w")).where("w <> ''")
        .groupBy("w").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    )
    size = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    odds = (
        F.log((F.col("bad") + 0.5) / (size.get(1, 0) + 1)) - F.log((F.col("good") + 0.5) / (size.get(0, 0) + 1))
        - 2 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    )
    enough = F.col("bad") >= max(SUPPORT, size.get(1, 0) / LEAST)
    return {r["w"]: r["odds"] for r in words.where(enough).select("w", odds.alias("odds")).where(F.col("odds") >= ODDS).collect()}


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be one of ``ids`` (doc_id): a Bloom filter of fixed size, no shuffle."""
    places = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(FILTER_BITS)) + 1 for k in range(FILTER_HASHES)]
    marked = ids.select(F.explode(F.array(*places)).alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    found = {r["bucket"]: r["bits"] for r in marked.collect()}
    each = 4096  # bytes of a bitmap
    none = bytes(each)
    bits = docs.sparkSession.sparkContext.broadcast(
        b"".join(bytes(found.get(i, none)) for i in range(1, FILTER_BITS // (8 * each) + 1)))

    @F.pandas_udf("boolean")
    def may_be(*at: pd.Series) -> pd.Series:
        known = np.frombuffer(bits.value, np.uint8)
        good = np.ones(len(at[0]), bool)
        for place in at:
            bit = place.to_numpy() - 1
            good &= (known[bit >> 3] >> (bit & 7) & 1).astype(bool)
        return pd.Series(good)

    return docs.where(F.col("doc_id").isNotNull()).where(may_be(*places))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label, fold, first) of the rows of ``docs`` with a label that are not held out, written once.

    Of several labels of a doc_id the largest counts; rows that repeat a doc_id and its text are one. Copies of a text
    share one of five folds; first marks the one that stands for them among those of one label. The joins are hinted to
    merge, so that the plan is one and the same at every size; of texts, only labelled ones are shuffled, once.
    """
    wanted = materialize(labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("toxic").cast("double").alias("label")))
    near = _among(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), wanted)
    near = near.withColumn("sha", F.unhex(F.sha2("text", 256)))
    marked = materialize(near.select("doc_id", "sha").distinct().join(wanted.hint("merge"), "doc_id"))
    firsts = marked.groupBy("sha", "label").agg(F.min("doc_id").alias("low"))
    marked = marked.join(firsts.hint("merge"), ["sha", "label"]).select(
        "doc_id", "sha", "label", F.pmod(F.xxhash64("sha"), F.lit(5)).alias("fold"), (F.col("doc_id") == F.col("low")).alias("first"))
    texts = near.groupBy("doc_id", "sha").agg(F.first("text").alias("text"))
    return materialize(texts.join(marked.hint("merge"), ["doc_id", "sha"]).drop("sha"))


class ToxicityModel:
    """A lexicon, trees and their calibration; without both labels to learn from, insults alone decide."""

    def __init__(self, lexicon: dict[str, float], trees: PipelineModel | None, calibration=None):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` without their text, with ``score`` from 0 to 1."""
        frame = with_features(docs, self.lexicon)
        names = [n for n in docs.columns if n != "text"]
        if self.trees is None:
            score = F.when(F.col("insult_any") + F.col("hidden_any") >= 2, 1.0).otherwise(0.0)
            return frame.select(*names, score.alias("score"))
        frame = _with_margin(self.trees.transform(frame))
        frame = self.calibration.transform(frame)
        # A hundredth of the raw probability orders documents inside one step of the calibration.
        score = 0.99 * F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0)) + 0.01 * F.col("raw")
        return frame.select(*names, score.alias("score"))


def _with_margin(frame: DataFrame) -> DataFrame:
    return frame.withColumn("raw", vector_to_array("probability")[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from the rows of ``docs`` (doc_id, text) with a label in ``labels`` (doc_id, toxic) that are not held out.

    The lexicon comes from the distinct texts of four folds, all of them; the trees from the same folds and the
    calibration from the fifth, whose words the lexicon has not seen, in a draw by a hash of the id of at most about
    ``sample`` rows in all. Empty tables and labels of one kind give a model without trees.
    """
    texts = labelled_texts(docs, labels)
    share = min(1.0, sample / max(1, texts.count()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    rows = texts.where(draw < int(share * 1_000_000)).select("text", "label", "fold")
    seen = {(r["label"], r["fold"] > 0) for r in rows.select("label", "fold").distinct().collect()}
    if len(seen) < 4:
        return ToxicityModel({}, None)
    lexicon = learn_lexicon(texts.where("first and fold > 0"))
    ready = materialize(with_features(rows, lexicon))
    # One input partition for a few thousand rows: small partitions only cost scheduling in each round of the trees.
    grown = PipelineModel([
        assembler := VectorAssembler(inputCols=FEATURES, outputCol="features"),
        GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.3, subsamplingRate=0.8, seed=7).fit(
            assembler.transform(ready.where("fold > 0").coalesce(4))),
    ])
    raw = _with_margin(grown.transform(ready.where("fold = 0"))).select("raw", "label")
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(
        raw.coalesce(1))
    return ToxicityModel(lexicon, grown, calibration)


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted. Null and empty texts are scored alike."""
    return model.score(docs.select("doc_id", held_out().alias("held_out"), "text")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, with all columns, that the model does not reject. A row without a doc_id is scored too."""
    names = docs.columns
    held = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("_row"), "text")
    return model.score(held).where(F.col("score") < THRESHOLD).select("_row.*")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
