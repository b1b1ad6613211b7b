"""Session settings the operators rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; cluster sizing (executors, memory, shuffle partitions) stays with the deployer.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lake files written by pandas carry nanosecond times; the lake reader turns them into timestamps.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Stream state (sale ids, open hours, customers) lives on disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "salesmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A missing setting is an error: a folder of one machine does not survive a lost executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    return folder


def run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; delete it once the application has ended."""
    return f"{shared_folder(spark).rstrip('/')}/salesmart-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and continue from there.

    Used where a result is read more than once or a loop would grow its lineage. Unlike a cached frame it is not
    lost with an executor; unlike a row checkpoint it is compressed, read by column, and its size is known to the
    join planner.
    """
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
