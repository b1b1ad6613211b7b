"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

Every text, without its white space, is cut where its content says so, and becomes a recipe: the ordered list of its
chunks' identifiers. Texts are equal when their recipes are, so from then on only recipes move, about a hundredth of
the text. Identifiers are verified: each distinct chunk content moves once, beside its hash, and where one hash has
two contents the recipes that hold it are told apart by the SHA-256 of the text as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import table, whole, without_white
from salesmart.session import materialize

#: A chunk ends at the first vowel or small digit before a punctuation mark after SHORTEST code points; texts without
#: such a place are cut at LONGEST. Where it is cut never changes which texts are equal.
SHORTEST, LONGEST = 512, 8192
CHUNKS = rf"(?s).{{{SHORTEST - 2},{LONGEST - 2}}}?[aeiou0-4][.,;:!?]|.{{1,{LONGEST}}}"


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text_sha256, recipe, recipe_key) for every row of ``docs``; a null text counts as empty."""
    return (
        docs.select("doc_id", F.length(whole("text")).cast("long").alias("n_chars"),
                    without_white(whole("text")).alias("norm"))
        .select("doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
                F.transform(F.regexp_extract_all("norm", F.lit(CHUNKS), F.lit(0)), lambda chunk: F.xxhash64(chunk)).alias("recipe"))
        .withColumn("recipe_key", F.xxhash64("recipe"))
    )


def ambiguous_chunks(docs: DataFrame) -> DataFrame:
    """(chunk_id): hashes that stand for two chunk contents or more. Each distinct content is shuffled once."""
    chunks = docs.select(
        F.explode(F.regexp_extract_all(without_white(whole("text")), F.lit(CHUNKS), F.lit(0))).alias("chunk")
    )
    contents = chunks.select(F.xxhash64("chunk").alias("chunk_id"), "chunk").distinct()
    return contents.groupBy("chunk_id").count().where("count > 1").select("chunk_id")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, any more columns): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without ``[\\x20\\x09-\\x0D]``; null and empty texts form one group. Of
    equal texts the one with most code points stays, then the smallest doc_id; a null doc_id comes last. Rows that
    repeat a doc_id are rows of their own in group_size and share ``kept``. An empty table gives an empty result.
    Hot groups: only minima and counts are gathered, combined before the shuffle; the join back is one that adaptive
    execution splits.
    """
    rows = materialize(recipes(docs))
    first = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("low"))).alias("first")
    # One row for each recipe and text hash, combined before the shuffle: a hot recipe is one row from here on.
    distinct = materialize(
        rows.groupBy("recipe_key", "recipe", "text_sha256").agg(first, F.count("*").alias("n")))
    unclear = (
        distinct.select("recipe_key", F.explode("recipe").alias("chunk_id")).distinct()
        .join(ambiguous_chunks(docs), "chunk_id", "left_semi").select("recipe_key").distinct()
    )
    exact = F.when(F.col("unclear"), F.col("text_sha256")).otherwise("")
    distinct = materialize(distinct.join(unclear.withColumn("unclear", F.lit(True)), "recipe_key", "left").select(
        "recipe_key", "recipe", "text_sha256", "first", "n", exact.alias("exact")))
    groups = distinct.groupBy("recipe_key", "recipe", "exact").agg(
        F.max("first").alias("first"), F.sum("n").alias("group_size"))
    # Written out, so that both sides of the last join are plain shuffles, of which a hot recipe's can be split.
    groups = materialize(distinct.drop("first", "n").join(groups, ["recipe_key", "recipe", "exact"]).drop("exact"))
    return rows.join(groups, ["recipe_key", "recipe", "text_sha256"]).select(
        "doc_id",
        F.bitwise_not("first.low").alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.bitwise_not("first.low")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns whose text stays; of rows that repeat doc_id and text, one.

    A row with a null doc_id stays unless an equal text with an id does.
    """
    groups = materialize(exact_groups(docs))
    state = groups.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"), F.first("kept").alias("kept"))
    state = materialize(state.where("not kept or n > 1").withColumnRenamed("text_sha256", "_sha"))
    names = docs.columns
    marked = docs.withColumn("_sha", F.sha2(without_white(whole("text")), 256)).alias("d").join(
        state.alias("s"),
        F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d._sha") == F.col("s._sha")), "left",
    )
    columns = [F.col(f"d.`{name}`").alias(name) for name in names]
    result = marked.where("s.kept is null").select(*columns)
    if not state.where("kept").isEmpty():  # rows that repeat a kept row
        result = result.union(marked.where("s.kept").select(*columns).dropDuplicates(["doc_id"]))
    return result


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
