"""Warehouse tables as parquet under one root, on any Hadoop file system.

Four ways of writing, chosen per table, all safe to repeat:

* fact rows are committed segments: a run replaces its earlier attempt, a rebuild everything, in one commit each;
* keyed marts are logs of upserts, merged when read and compacted in bounded steps;
* alerts replace the partition of their run (or streaming batch);
* snapshots go to a new ``version=`` directory, and readers take the newest complete one, so a job can read the
  previous state while it writes the next and a failed write changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.upsert import duplicate_keys
from salesmart.operators import marts
from salesmart.schemas import TABLES, UNIQUE_KEYS
from salesmart.sources.commits import CommittedTable, MergedTable
from salesmart.sources.lake import read_or_empty

# Columns that are not part of a table's own schema.
EXTRA_PARTITIONS: dict[str, list[T.StructField]] = {
    "silver.sales_enriched": [T.StructField("ingest", T.StringType())],
    "inventory_alerts": [T.StructField("run", T.StringType())],
}

# Tables as commits, with the columns that partition their segments and the one that names a row's run, and marts as logs of upserts.
COMMITTED: dict[str, tuple[list[str], str]] = {"silver.sales_enriched": (["sale_date_only"], "ingest")}
MERGED: dict[str, tuple[str, ...]] = {
    "gold.mart_sales": (*marts.SALES_UPDATES, "updated_at"),
    "gold.mart_account": (*marts.ACCOUNT_UPDATES, "updated_at"),
}


def stamp_text(moment: datetime | str) -> str:
    """Sortable text of a run time, used in partition and version names."""
    return datetime.fromisoformat(str(moment)).strftime("%Y%m%dT%H%M%S")


class Warehouse:
    """Paths and reads and writes of the tables in ``schemas.TABLES``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/lake/raw/sales"
        self.bronze = f"{self.root}/lake/bronze/sales"
        self.fast_track = f"{self.root}/lake/raw/fast_track"

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name.replace('.', '/')}"

    def schema(self, name: str) -> T.StructType:
        return T.StructType([*TABLES[name].fields, *EXTRA_PARTITIONS.get(name, [])])

    # --- committed and merged tables ---

    def committed(self, name: str) -> CommittedTable:
        return CommittedTable(self.spark, self.path(name), self.schema(name), *COMMITTED[name])

    def merged(self, name: str) -> MergedTable:
        return MergedTable(self.spark, self.path(name), self.schema(name), UNIQUE_KEYS[name], MERGED[name])

    # --- plain and partitioned tables ---

    def read(self, name: str) -> DataFrame:
        """A table with its extra columns, committed and merged ones as of their newest commit; empty before the first write."""
        if name in COMMITTED:
            return self.committed(name).read()
        if name in MERGED:
            return self.merged(name).read()
        return read_or_empty(self.spark, self.path(name), self.schema(name))

    def conform(self, name: str, df: DataFrame) -> DataFrame:
        """Columns of the table in order and type; missing ones are NULL."""
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema(name).fields
        ]
        return df.select(*columns)

    def append(self, name: str, df: DataFrame) -> None:
        self.conform(name, df).write.mode("append").parquet(self.path(name))

    def replace_run(self, name: str, column: str, run: str, df: DataFrame) -> None:
        """The rows of one run, named in ``column``, in place of an earlier attempt of the same run."""
        if name in COMMITTED:
            self.committed(name).replace_run(run, df.withColumn(column, F.lit(run)))
            return
        rows = self.conform(name, df.withColumn(column, F.lit(run))).drop(column)
        rows.write.mode("overwrite").parquet(f"{self.path(name)}/{column}={run}")

    def runs(self, name: str, column: str) -> list[str]:
        """The runs that have written to a table, oldest first: a listing of one directory."""
        return [value for value, _ in self._folders(name, column)]

    # --- versioned snapshots ---

    def _folders(self, name: str, column: str) -> list:
        jvm = self.spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = base.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return []
        folders = (status.getPath() for status in fs.listStatus(base))
        prefix = f"{column}="
        return sorted(((p.getName().removeprefix(prefix), p) for p in folders if p.getName().startswith(prefix)), key=lambda x: x[0])

    def _complete(self, folder) -> bool:
        marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)

    def versions(self, name: str) -> list[str]:
        """Complete versions, oldest first."""
        return [version for version, folder in self._folders(name, "version") if self._complete(folder)]

    def latest(self, name: str, before: str | None = None) -> DataFrame | None:
        """Newest version, or the newest one older than ``before``; None when there is none."""
        for version, folder in reversed(self._folders(name, "version")):  # only the newest ones are looked into
            if (before is None or version < before) and self._complete(folder):
                return self.spark.read.schema(TABLES[name]).parquet(f"{self.path(name)}/version={version}")
        return None

    def latest_or_empty(self, name: str, before: str | None = None) -> DataFrame:
        found = self.latest(name, before)
        return self.spark.createDataFrame([], TABLES[name]) if found is None else found

    def save_version(self, name: str, version: str, df: DataFrame) -> None:
        """Write a snapshot; repeating a version replaces it."""
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[name].fields
        ]
        df.select(*columns).write.mode("overwrite").parquet(f"{self.path(name)}/version={version}")

    # --- keys ---

    def duplicates(self, name: str) -> DataFrame:
        """Keys that break the table's unique key, with their row counts; empty on a sound table."""
        versioned = name not in COMMITTED and name not in MERGED and self.versions(name)
        rows = self.latest_or_empty(name) if versioned else self.read(name)
        return duplicate_keys(rows, UNIQUE_KEYS[name])

    # --- names for SQL ---

    def register_views(self) -> None:
        """Create or refresh catalog views (``gold.mart_sales`` …), so dashboard SQL runs as it is.

        Tables that have no rows yet become empty views with the right columns.
        """
        for name, schema in TABLES.items():
            if "." in name:
                self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
            known = self.committed(name) if name in COMMITTED else self.merged(name) if name in MERGED else None
            if known is not None and (body := known.view_sql()):
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
                continue
            versions = [] if known else self.versions(name)
            location = f"{self.path(name)}/version={versions[-1]}" if versions else self.path(name)
            if not known and not read_or_empty(self.spark, location, schema).isEmpty():
                columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
                body = f"SELECT {columns} FROM parquet.`{location}`"
            else:
                columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
                body = f"SELECT {columns} WHERE FALSE"
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
