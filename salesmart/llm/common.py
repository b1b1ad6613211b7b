"""What the text operators share: table readers, batch limits, connected components."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import materialize

#: Spark's setting for deleting a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The whitespace of all text contracts, ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"
#: Edges from which a round of ``components`` writes with another task.
EDGES_EACH = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once: texts may be very long, so batches are cut by bytes as well."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def whole(text: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def without_white(text: Column) -> Column:
    for char in WHITE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows no model may learn from: crc32 of the id as text, modulo 4, is 2. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def written(df: DataFrame) -> DataFrame:
    """``materialize``, with the files of the step's shuffles deleted as soon as it is written.

    Executors would keep them until the driver has collected its garbage, which a driver with little to do seldom does, and
    its cleaner has come to them: a chain of large steps would keep several steps' files at once.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        result = materialize(df)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return result


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame from ``written`` that nothing reads any more: all that came from it is written too."""
    spark = frame.sparkSession
    if files := frame.inputFiles():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node it can reach.

    Alternates two exchanges of edges until nothing changes: every node hangs its larger neighbours on its smallest
    neighbour, then all its smaller neighbours and itself. Edges stay distributed and each step is written out, so a
    lost executor costs one step. A hub with very many edges is only ever aggregated (minimum, combined before
    the shuffle) and joined, never gathered. A round of few edges is written by few tasks, whatever the number of
    partitions; neither exchange makes more edges than there were. Self edges are allowed; nulls are ignored.
    """
    current = materialize(
        edges.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    nodes = materialize(current.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    current = current.where("u <> v")
    mark = lambda df: df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(hash(v, u))")).first()
    seen = mark(current)
    while seen[0]:
        both = current.union(current.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        few = 1 + seen[0] // EDGES_EACH
        large = materialize(large.coalesce(few))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        current = materialize(small.coalesce(few))
        if (now := mark(current)) == seen:
            break
        seen = now
    return nodes.join(current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component")
    )
