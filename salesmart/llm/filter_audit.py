"""How filters overlap: Hart and Mas-Colell's potential of the removal game, exact, for each part of the corpus.

A coalition of filters removes the documents that fail any of them. Documents are counted by the set of filters they
fail, so a corpus becomes at most 32 counts for each part. From them come the removals of all 32 coalitions; every step
of every order of filters is the difference of two of them, and every filter's Shapley value the difference of two
potentials, which are computed recursively from the empty coalition up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import small_batches, table

FILTERS = "ABCDE"
_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"
#: The bit of filter E, which needs the other documents.
_COPY = 16


def text_failures(text: str | None) -> tuple[int, bytes]:
    """The filters A to D that a text fails, as bits from A on, and the text's SHA-256. Null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    found = len(words) < 200
    found |= (100 * len(set(words)) < 50 * len(words)) << 1
    found |= (100 * (len(data) - len(data.translate(None, _CAPITALS))) > 3 * len(text or "")) << 2
    found |= (len(data) > len(data.translate(None, _MARKS))) << 3
    return int(found), hashlib.sha256(data).digest()


def _failing(docs: DataFrame) -> DataFrame:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_failures(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([f for f, _ in found], pa.int32()),
                 pa.array([h for _, h in found], pa.binary())],
                names=["doc_id", "part", "fails", "sha"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text") \
        .mapInArrow(judge, "doc_id long, part string, fails int, sha binary")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and by the set of filters they fail, as bits from A on.

    A text that a third of all documents share is combined before each shuffle, so it never meets in one task; rows
    without a doc_id are spread over the join, where they match nothing.
    """
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("sha")).otherwise(F.lit(0).cast("long"))
    rows = _failing(docs).groupBy("doc_id", "part", "fails", "sha").agg(F.count("*").alias("n")).withColumn("spread", spread)
    says = lambda name: F.max((F.col(name) == 1).cast("int")).alias(name)
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(says("quality"), says("toxic"))
    marks = marks.withColumn("spread", F.lit(0).cast("long"))
    is_set = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    joined = rows.join(marks, ["doc_id", "spread"], "left").select(
        "doc_id", "part", "fails", "sha", "n", is_set("quality"), is_set("toxic"))
    alike = joined.groupBy("sha", "part", "fails", "quality", "toxic", F.col("doc_id").isNull().alias("nameless")).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("n_low"))
    # A text has few rows by now: one for each part and pair of labels.
    first = F.min("low").over(Window.partitionBy("sha"))
    alone = F.when(F.col("nameless"), F.col("n")).when(F.col("low") == first, F.col("n_low")).otherwise(0)
    split = F.array(F.struct("fails", F.col("alone").alias("n")),
                    F.struct(F.col("fails").bitwiseOR(_COPY).alias("fails"), (F.col("n") - F.col("alone")).alias("n")))
    return (
        alike.withColumn("alone", alone).select("part", "quality", "toxic", F.inline(split))
        .groupBy("part", "fails").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("quality")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    )


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(FILTERS[0]))


def potentials(removed: Column, players: int) -> Column:
    """The potential of every coalition, times the factorial of its size, from ``removed``, the game's value by coalition.

    P(S) = (v(S) + sum of P(S without i)) / |S|; with Q(S) = |S|! P(S) this is Q(S) = (|S| - 1)! v(S) + sum of
    Q(S without i), in integers. A coalition's number is larger than those of its parts, so one pass upwards will do.
    """
    factorials = F.array(*(F.lit(factorial(k)) for k in range(players)))

    def step(known: Column, coalition: Column) -> Column:
        own = F.get(factorials, F.bit_count(coalition) - 1) * F.element_at(removed, coalition + 1)
        for i in range(players):
            without = coalition.bitwiseXOR(F.lit(1 << i))
            own = own + F.when(coalition.bitwiseAND(1 << i) != 0, F.get(known, without)).otherwise(F.lit(0))
        return F.concat(known, F.array(own.cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**players - 1)), F.array(F.lit(0).cast("long")), step)


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley (summed over all orders), from ``failure_counts``."""
    grand = 2 ** len(FILTERS) - 1
    # At most 32 rows a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("found"), F.sum("n").alias("docs"))

    def game(value: str) -> Column:
        def removed(coalition: Column) -> Column:
            hit = F.filter("found", lambda x: x["fails"].bitwiseAND(coalition) != 0)
            return F.aggregate(hit, F.lit(0).cast("long"), lambda total, x: total + x[value])

        return F.transform(F.sequence(F.lit(0), F.lit(grand)), removed).alias(f"v_{value}")

    games = parts.select("part", "docs", game("n"), game("good"), game("toxic"))
    games = games.withColumn("q", potentials(F.col("v_n"), len(FILTERS)))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = games.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letters = F.filter(F.split("filter_order", ""), lambda x: x != "")
    earlier = F.aggregate(F.slice(letters, F.lit(1), F.col("step") - 1), F.lit(0), lambda mask, x: mask + _bit(x))
    steps = steps.withColumn("own", _bit(F.element_at(letters, F.col("step")))).withColumn("earlier", earlier)
    value = lambda name, coalition: F.get(F.col(name), coalition)
    own, before = F.col("own"), F.col("earlier")
    after, others = before.bitwiseOR(own), own.bitwiseXOR(F.lit(grand))
    gain = lambda name: value(name, after) - value(name, before)
    return steps.select(
        "part", "filter_order", "step",
        (F.col("docs") - value("v_n", after)).alias("kept"),
        gain("v_n").alias("removed"),
        (value("v_n", own) - gain("v_n")).alias("redundant"),
        (value("v_n", F.lit(grand)) - value("v_n", others)).alias("unique_fails"),
        gain("v_good").alias("good_lost"),
        gain("v_toxic").alias("toxic_lost"),
        (value("q", F.lit(grand)) - len(FILTERS) * value("q", others)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of filters A to E on ``docs`` (doc_id, text, lang, any more columns) with ``labels`` (doc_id,
    quality, toxic): 600 rows for each value of lang, in ``part``; null lang counts as the empty string.

    A: under 200 words; B: under half of the words distinct; C: over 3 in 100 code points are A to Z; D: holds one of
    ``#$%&*|``; E: a smaller doc_id has the same text. Null and empty texts are one text and fail A. Rows without a
    doc_id never fail E, nor make others fail it, and have no labels; rows that repeat the smallest doc_id of a text
    do not fail E. Of several labels of one doc_id, any that is 1 counts. Empty ``docs`` give no rows, empty ``labels``
    no losses.
    """
    small_batches(docs.sparkSession)
    return interactions(failure_counts(docs, labels))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Every order walked step by step over the counted documents, every document's failures found anew.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low
  FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS quality, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN d.doc_id > low THEN 'E' END) AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(quality) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), o AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM o, (SELECT unnest(range(1, 6)) AS step) WHERE length(filter_order) = 5
), r AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails = own AS alone, contains(fails, own) AS hit,
         earlier <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone
  FROM c, s
), g AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g
"""
