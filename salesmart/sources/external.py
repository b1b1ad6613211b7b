"""Edges to other systems: JDBC tables, catalog landing tables and message sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    **properties: str,
) -> DataFrame:
    """Projection of a database table; with ``split_on`` and ``bounds`` it is read by parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in properties.items():
        reader = reader.option(key, value)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load().select(*columns)


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.save()


def append_landing(df: DataFrame, table: str = "raw_sales") -> None:
    """Append raw rows to a catalog table, creating it on first use."""
    df.write.mode("append").saveAsTable(table)


def send(messages: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Write key/value messages to a batch sink (``kafka`` needs its connector on the cluster)."""
    writer = messages.write.format(sink)
    for key, value in options.items():
        writer = writer.option(key, value)
    if sink != "kafka":
        writer = writer.mode("append")
    writer.save()


def send_stream(messages: DataFrame, checkpoint: str, sink: str = "kafka", **options: str) -> StreamingQuery:
    """The streaming form; processes what has arrived and stops."""
    writer = messages.writeStream.format(sink).option("checkpointLocation", checkpoint)
    for key, value in options.items():
        writer = writer.option(key, value)
    return writer.trigger(availableNow=True).start()
