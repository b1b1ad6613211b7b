"""A committed table whose files are clustered along a curve and described by a small index, in place of secondary indexes.

A segment's rows are ordered by the interleaved bits of their columns' ranks, so a file holds a narrow range of each
column. The index has one row a file: row count, smallest and largest value of each column, and 4 KB of marks, one bit
for the hash of each value met. A search reads the index first and opens only files that can hold a match; the search is
repeated on their rows, so the index never decides what is returned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import materialize
from salesmart.sources.commits import CommittedTable

#: Rows of a file, and the most tasks that write one segment; beyond that a task writes several files.
FILE_ROWS, MOST_TASKS = 1_000_000, 20_000
#: Bits of a column's rank: its place among 255 quantiles.
RANK_BITS = 8
#: Bits of a file's marks for one column (what the bitmap functions hold).
MARKS = 32_768


def _literal(value: Any, kind: T.DataType) -> Column:
    """A value in a column's type; times go through their text, which has no time zone."""
    return F.lit(value if value is None or isinstance(value, (str, bytes)) else str(value)).cast(kind)


def _number(name: str, kind: T.DataType) -> tuple[Column, T.DataType]:
    """A column as a value whose quantiles can be taken; text is ordered by its hash, which serves equality."""
    if isinstance(kind, (T.StringType, T.BinaryType, T.BooleanType)):
        return F.when(F.col(name).isNotNull(), F.xxhash64(name)), T.LongType()
    return F.col(name), kind


def _rank(value: Column, kind: T.DataType, cuts: Sequence[Any]) -> Column:
    """How many of the 255 ascending ``cuts`` are not over ``value``, by halving; 0 for null."""
    bounds = F.array(*(_literal(c, kind) for c in cuts))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(RANK_BITS))))
    return F.when(value.isNull(), 0).otherwise(F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.element_at(bounds, at + step) <= value, at + step).otherwise(at)))


def with_curve(df: DataFrame, turns: Sequence[str]) -> tuple[DataFrame, int]:
    """``df`` with ``_curve``, its place on the curve, and the number of its rows; ``df`` is read twice.

    ``turns`` names the columns in the order in which they give a bit; a column named twice gives two bits in a round and
    so gets narrower files. Ranks come from quantiles of the rows at hand, so a value with a third of all rows takes a
    third of the curve and no more.
    """
    columns = list(dict.fromkeys(turns))
    number = {c: _number(c, df.schema[c].dataType) for c in columns}
    shares = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    found = df.agg(F.count("*"), *(F.percentile_approx(number[c][0], shares, 2_000) for c in columns)).first()
    rank = {c: _rank(*number[c], cuts) if cuts else F.lit(0) for c, cuts in zip(columns, found[1:])}
    left, bits = dict.fromkeys(columns, RANK_BITS), []
    while any(left.values()):
        for c in turns:
            if left[c]:
                left[c] -= 1
                bits.append((c, left[c]))
    bits = bits[:62]
    ranked = df.withColumns({f"_rank_{i}": rank[c] for i, c in enumerate(columns)})
    place = {c: F.col(f"_rank_{i}").cast("long") for i, c in enumerate(columns)}
    curve = reduce(lambda a, b: a.bitwiseOR(b), (
        F.shiftleft(F.shiftright(place[c], bit).bitwiseAND(F.lit(1)), len(bits) - 1 - i) for i, (c, bit) in enumerate(bits)))
    return ranked.withColumn("_curve", curve).select(*df.columns, "_curve"), found[0]


def _mark(value: Column) -> Column:
    return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(MARKS)))


def _marked(marks: Column, value: Column) -> Column:
    """Whether the bit of ``value`` is set."""
    place = _mark(value)
    byte = F.conv(F.hex(F.substr(marks, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), F.pmod(place, F.lit(8))).cast("int")) != 0


class SkippingTable(CommittedTable):
    """A ``CommittedTable`` that opens only files which can hold what is searched for by the columns of ``turns``.

    Segments without an index, written before the table became one of this kind, are read whole.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, turns: Sequence[str], within: Sequence[str] = (),
                 run_column: str | None = None, file_rows: int = FILE_ROWS) -> None:
        super().__init__(spark, path, schema, within, run_column)
        self.turns, self.file_rows = list(turns), file_rows
        self.columns = list(dict.fromkeys(turns))

    def _write(self, frame: DataFrame, name: str) -> None:
        rows, n = with_curve(materialize(frame), self.turns)
        tasks = min(max(1, -(-n // self.file_rows)), MOST_TASKS)
        # The hash of the whole row parts a hot value's rows, so no task takes more than its share.
        order = [*self.within, "_curve"]
        placed = rows.withColumn("_tie", F.xxhash64(*frame.columns)).repartitionByRange(tasks, *order, "_tie")
        writer = placed.sortWithinPartitions(*order, *self.columns).drop("_curve", "_tie").write.option("maxRecordsPerFile", self.file_rows)
        (writer.partitionBy(*self.within) if self.within else writer).parquet(f"{self.path}/data/part_of={name}")
        files = self._scan([{"name": name, "run": None, "struck": []}]).withColumn(
            "file", F.regexp_extract("_metadata.file_path", "/data/(part_of=[^/]*/.*)$", 1))
        described = [f(c) for c in self.columns for f in (
            lambda c: F.min(c).alias(f"min_{c}"), lambda c: F.max(c).alias(f"max_{c}"),
            lambda c: F.bitmap_construct_agg(_mark(F.col(c))).alias(f"marks_{c}"))]
        files.groupBy("file").agg(F.count("*").alias("rows"), *described).write.parquet(f"{self.path}/index/part_of={name}")

    # --- searches ---

    def index(self, version: int | None = None) -> DataFrame | None:
        """One row for each file of a commit: file, rows, and min_, max_ and marks_ of the columns; None without files."""
        known = set(self._names("index"))
        folders = [f"part_of={s['name']}" for s in self.segments(version) if s["rows"] and f"part_of={s['name']}" in known]
        return self.spark.read.parquet(*(f"{self.path}/index/{f}" for f in folders)) if folders else None

    def _typed(self, column: str, value: Any) -> Column:
        if column not in self.columns:
            raise ValueError(f"{column} is not in the index, which has {', '.join(self.columns)}")
        return _literal(value, self.schema[column].dataType)

    def files_for(self, equal: Mapping[str, Any], between: Mapping[str, tuple[Any, Any]] | None = None, version: int | None = None) -> list[str]:
        """Files, below ``data/``, that can hold rows with these values and ranges (both ends included).

        Only their names come to the driver, which Spark lists there for any scan.
        """
        files = self.index(version)
        if files is None:
            return []
        for column, value in equal.items():
            value = self._typed(column, value)
            files = files.where(value.between(F.col(f"min_{column}"), F.col(f"max_{column}")) & _marked(F.col(f"marks_{column}"), value))
        for column, (low, high) in (between or {}).items():
            files = files.where((F.col(f"min_{column}") <= self._typed(column, high)) & (F.col(f"max_{column}") >= self._typed(column, low)))
        return sorted(r["file"] for r in files.select("file").collect())

    def search(self, equal: Mapping[str, Any], between: Mapping[str, tuple[Any, Any]] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a commit with these values and within these ranges. A null matches nothing."""
        segments = self.segments(version)
        known = set(self._names("index"))
        paths = [*self.files_for(equal, between, version),
                 *(f"part_of={s['name']}" for s in segments if s["rows"] and f"part_of={s['name']}" not in known)]
        rows = self._scan(segments, paths)
        for column, value in equal.items():
            rows = rows.where(F.col(column) == self._typed(column, value))
        for column, (low, high) in (between or {}).items():
            rows = rows.where(F.col(column).between(self._typed(column, low), self._typed(column, high)))
        return rows.select(*self.schema.fieldNames())

    def expire(self, since: datetime | str, grace_hours: float = 24) -> tuple[int, int]:
        gone = super().expire(since, grace_hours)
        for folder in set(self._names("index")) - set(self._names("data")):
            self._fs.delete(self._at("index", folder), True)
        return gone
