"""The partitioned file lake: hourly sales and fast-track records as parquet on any Hadoop file system.

Partitions are ingest time (the run), not sale time, as zero-padded strings: ``year=2024/month=01/day=15/hour=13``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.expressions import at
from salesmart.operators.quality import with_file_order
from salesmart.schemas import FAST_TRACK_PARTITIONS, LAKE_PARTITIONS, LAKE_SALES

_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
#: What readers say of pages that do not decode.
_BROKEN_DATA = ("could not read page", "Could not decompress", "FAILED_TO_UNCOMPRESS", "can not read class org.apache.parquet")


def with_partitions(df: DataFrame, moment: Column, parts: Sequence[str] = LAKE_PARTITIONS) -> DataFrame:
    """Add the partition columns of an ingest time."""
    return df.withColumns({part: F.date_format(moment, _FORMATS[part]) for part in parts})


def _values(run_at: datetime | str) -> dict[str, str]:
    stamp = datetime.fromisoformat(str(run_at))
    return {
        "year": f"{stamp.year:04d}",
        "month": f"{stamp.month:02d}",
        "day": f"{stamp.day:02d}",
        "hour": f"{stamp.hour:02d}",
    }


def hour_of(df: DataFrame, run_at: datetime | str) -> DataFrame:
    """Rows of one ingest hour; on a lake scan this prunes to one directory."""
    for part, value in _values(run_at).items():
        df = df.where(F.col(part) == value)
    return df


def scan_or_none(spark: SparkSession, path: str, schema: T.StructType | None, **options: str) -> DataFrame | None:
    """Parquet scan, or None while the path does not exist or (without a schema) holds no readable file."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Parquet scan with a fixed schema; a path that does not exist yet is an empty table."""
    scan = scan_or_none(spark, path, schema, **options)
    return spark.createDataFrame([], schema) if scan is None else scan


def conform_raw(scan: DataFrame) -> DataFrame:
    """Raw columns in the canonical types, whatever wrote the files.

    Sale ids may be numbers, amounts doubles and times nanoseconds since 1970; partition values that were
    inferred as numbers get their zeros back.
    """

    def column(field: T.StructField):
        source = F.col(field.name)
        if field.name in _FORMATS:
            text = F.lpad(source.cast("string"), len(_FORMATS[field.name]), "0")
            return text.alias(field.name)
        if field.name == "sale_date" and isinstance(scan.schema[field.name].dataType, T.LongType):
            nanos = source - F.pmod(source, F.lit(1000))
            source = F.timestamp_micros((nanos / 1000).cast("bigint"))
        return source.cast(field.dataType).alias(field.name)

    return scan.select(*[column(f) for f in LAKE_SALES.fields], *[c for c in ("_file", "_row") if c in scan.columns])


def _ordered(spark: SparkSession, scan: DataFrame | None) -> DataFrame:
    if scan is not None:
        return conform_raw(with_file_order(scan))
    empty = spark.createDataFrame([], LAKE_SALES)
    return empty.withColumns({"_file": F.lit(""), "_row": F.lit(0).cast("bigint")})


def write_batch(df: DataFrame, root: str, run_at: datetime | str) -> None:
    """Write one hour's sales; running the same hour again replaces its partition and no other."""
    (
        with_partitions(df, at(run_at))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*LAKE_PARTITIONS)
        .parquet(root)
    )


def write_fast_track(df: DataFrame, root: str, received_at: datetime | str) -> None:
    """Append high-value records under their day."""
    (
        with_partitions(df, at(received_at), FAST_TRACK_PARTITIONS)
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy(*FAST_TRACK_PARTITIONS)
        .parquet(root)
    )


def read_hour(spark: SparkSession, root: str, run_at: datetime | str) -> DataFrame:
    """One hour's files with their row order; no files, no rows. Lists that hour's directory only."""
    path = "/".join([root, *[f"{part}={value}" for part, value in _values(run_at).items()]])
    return _ordered(spark, scan_or_none(spark, path, None, basePath=root))


def lake_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of all parquet files below ``root``; their contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(row.path for row in files.collect())


def corruption(error: Exception) -> str | None:
    """What is broken in a parquet file that could not be read: ``footer`` or ``data``; None for any other error.

    Lost executors, storage that does not answer, missing files and denied access are no corruption.
    """
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        kind, text = cause.getClass().getName(), cause.getMessage() or ""
        if "is not a Parquet file" in text or "corrupted file: the footer" in text:
            return "footer"
        if kind.startswith("org.apache.parquet.") or any(sign in text for sign in _BROKEN_DATA):
            return "data"
        cause = cause.getCause()
    return None


def unreadable_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """Those of ``paths`` that are no sound parquet files, with what is broken; any other error is raised.

    All files are read at once; where that fails, each half again, so a few broken files among many cost some passes
    over ever smaller parts and no job for every file.
    """
    if not paths:
        return []
    try:
        spark.read.parquet(*paths).write.format("noop").mode("overwrite").save()
        return []
    except (PySparkException, Py4JJavaError) as error:  # a broken footer fails in the driver's own job
        if (reason := corruption(error)) is None:
            raise
        if len(paths) == 1:
            return [(paths[0], reason)]
    middle = len(paths) // 2
    return unreadable_files(spark, paths[:middle]) + unreadable_files(spark, paths[middle:])


def read_lake(spark: SparkSession, root: str, skip: Sequence[str] = ()) -> DataFrame:
    """All lake files with their arrival order, but for those in ``skip``, which stay out whole."""
    if not skip:
        return _ordered(spark, scan_or_none(spark, root, None))
    paths = [path for path in lake_files(spark, root) if path not in set(skip)]
    return _ordered(spark, spark.read.option("basePath", root).parquet(*paths) if paths else None)


def copy_hour(spark: SparkSession, raw_root: str, bronze_root: str, run_at: datetime | str) -> bool:
    """Copy one hour partition from raw to bronze, replacing an earlier copy; False when the hour has no rows.

    The copy is sorted by arrival, so that "first row per sale" means the same in both layers.
    """
    hour = read_hour(spark, raw_root, run_at)
    if hour.isEmpty():
        return False
    (
        hour.orderBy("_file", "_row")
        .drop("_file", "_row")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*LAKE_PARTITIONS)
        .parquet(bronze_root)
    )
    return True
