"""Tables whose state is a commit: readers pin one, writers publish a new one by a single rename.

Rows live in immutable segments, ``data/part_of=<name>/…``, one for each run that wrote. A commit is a small text file,
``commits/<number>.json``, that lists the live segments; it appears by a rename that fails where the number is taken. A
run that stops before its commit leaves the table as it was, with an unlisted segment that ``expire`` clears away.
The file system must offer an atomic rename, as HDFS and local disks do.

``MergedTable`` puts keyed upserts on top: every batch is one more segment, readers take the newest values of a key, and
``compact_step`` merges neighbouring segments of like size, so that a row is rewritten a few times and not in every batch.
``SummedTable`` does the same for signed changes of totals.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.upsert import any_null, require_unique

#: Segments of like size that are merged in one step.
FAN_IN = 4


class CommitConflict(RuntimeError):
    """Another writer has committed since this one looked."""


def _text(moment: datetime | str | None) -> str:
    moment = datetime.now(timezone.utc).replace(tzinfo=None) if moment is None else datetime.fromisoformat(str(moment))
    return moment.isoformat(timespec="microseconds")


class CommittedTable:
    """A table under ``path`` with the columns of ``schema``; segments are partitioned by the columns ``within``.

    ``run_column`` names the run of every row where a rebuild writes many runs in one segment; a run that is replaced
    afterwards is struck out there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, within: Sequence[str] = (), run_column: str | None = None) -> None:
        self.spark, self.path, self.schema, self.within, self.run_column = spark, path.rstrip("/"), schema, list(within), run_column
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    # --- files ---

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _names(self, folder: str) -> list[str]:
        where = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _publish(self, text: str, name: str) -> None:
        draft, final = self._at("commits", f".{uuid.uuid4().hex}"), self._at("commits", name)
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, no_overwrite)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise CommitConflict(f"{final} exists") from None
            raise

    # --- commits ---

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("commits") if n.endswith(".json") and n[0] != "."]

    def latest(self) -> int:
        """The newest commit's number; 0 before the first."""
        return max(self.versions(), default=0)

    def _commit(self, version: int) -> dict:
        if version == 0:
            return {"at": "", "segments": []}
        stream = self._fs.open(self._at("commits", f"{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def segments(self, version: int | None = None) -> list[dict]:
        """The live segments of a commit, in the order in which they were written: name, run (null for many), rows, struck."""
        return self._commit(self.latest() if version is None else version)["segments"]

    def version_at(self, moment: datetime | str) -> int:
        """The newest commit made at or before a moment; 0 if there was none."""
        moment = _text(moment)
        return max((v for v in self.versions() if self._commit(v)["at"] <= moment), default=0)

    def commit(self, base: int, segments: list[dict], at: datetime | str | None = None) -> int:
        """Publish ``segments`` as the state after commit ``base``; a conflict if that is no longer the newest."""
        if self.latest() != base:
            raise CommitConflict(f"{self.path} has moved on from commit {base}")
        self._publish(json.dumps({"at": _text(at), "segments": segments}), f"{base + 1:012d}.json")
        return base + 1

    # --- rows ---

    def write_segment(self, run: str | None, df: DataFrame, order: str = "") -> dict:
        """Write rows that no commit lists yet; the rebalance hint gives few files of even size and splits hot values."""
        name = f"{order}{uuid.uuid4().hex}"
        frame = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                            else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields))
        self._write(frame, name)
        segment = {"name": name, "run": run, "struck": []}
        return {**segment, "rows": self._scan([segment]).count()}

    def _write(self, frame: DataFrame, name: str) -> None:
        writer = (frame.hint("rebalance", *self.within) if self.within else frame).write
        (writer.partitionBy(*self.within) if self.within else writer).parquet(f"{self.path}/data/part_of={name}")

    def _struck(self, segments: Sequence[dict], name: str) -> str:
        """SQL that is true for rows of replaced runs."""
        quoted = lambda texts: ", ".join("'" + t.replace("'", "''") + "'" for t in texts)
        return " OR ".join(f"({name} = {quoted([s['name']])} AND {self.run_column} IN ({quoted(s['struck'])}))" for s in segments if s["struck"])

    def _scan(self, segments: Sequence[dict], paths: Sequence[str] | None = None) -> DataFrame:
        """The rows of ``segments``, or only those below ``paths`` of their files."""
        paths = [f"part_of={s['name']}" for s in segments] if paths is None else paths
        if not paths:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn("part_of", F.lit(None).cast("string"))
        fields = [f for f in self.schema.fields]
        reader = self.spark.read.schema(T.StructType([*fields, T.StructField("part_of", T.StringType())]))
        rows = reader.option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{p}" for p in paths])
        struck = self._struck(segments, "part_of")
        return rows.where(f"NOT coalesce({struck}, false)") if struck else rows

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a commit, the newest by default; later commits do not change a frame that was made before them."""
        return self._scan(self.segments(version)).select(*self.schema.fieldNames())

    def changes(self, after: int, until: int | None = None) -> DataFrame:
        """Rows of segments that came after one commit and are live in another, for readers that go on from there."""
        known = {s["name"] for s in self.segments(after)}
        return self._scan([s for s in self.segments(until) if s["name"] not in known]).select(*self.schema.fieldNames())

    def _change(self, run: str | None, df: DataFrame, keep: Callable[[dict], dict | None], at: datetime | str | None,
                note: dict | None = None) -> int:
        added = {**self.write_segment(run, df), **(note or {})}
        while True:
            base = self.latest()
            try:
                return self.commit(base, [*filter(None, map(keep, self.segments(base))), added], at)
            except CommitConflict:
                continue  # what to keep is decided anew on the newest state

    def replace_run(self, run: str, df: DataFrame, at: datetime | str | None = None, **note) -> int:
        """The rows of one run, in place of an earlier attempt of the same run, in one commit; ``note`` is kept with them."""
        def keep(segment: dict) -> dict | None:
            if segment["run"] is None:
                return {**segment, "struck": sorted({*segment["struck"], run})}
            return segment if segment["run"] != run else None

        return self._change(run, df, keep, at, note)

    def replace_all(self, df: DataFrame, at: datetime | str | None = None) -> int:
        """A rebuild: the table holds nothing but these rows afterwards; ``df`` may read the table itself."""
        before = {s["name"] for s in self.segments()}
        return self._change(None, df, lambda s: s if s["name"] not in before else None, at)

    def expire(self, since: datetime | str, grace_hours: float = 24) -> tuple[int, int]:
        """Forget commits that no reader as of ``since`` or later can need, then clear segments that no commit lists.

        Segments younger than ``grace_hours`` stay: they may belong to a run that has not committed yet. Returns how
        many commits and segments went.
        """
        first = self.version_at(since)
        gone = [v for v in self.versions() if v < first]
        for version in gone:
            self._fs.delete(self._at("commits", f"{version:012d}.json"), False)
        live = {s["name"] for v in self.versions() for s in self._commit(v)["segments"]}
        oldest = (datetime.now(timezone.utc).timestamp() - 3600 * grace_hours) * 1000
        cleared = 0
        for folder in self._names("data"):
            where = self._at("data", folder)
            if folder.removeprefix("part_of=") not in live and self._fs.getFileStatus(where).getModificationTime() <= oldest:
                self._fs.delete(where, True)
                cleared += 1
        return len(gone), cleared

    # --- SQL ---

    def view_sql(self, *more: str) -> str | None:
        """The newest commit's rows as SQL text, with ``more`` columns (``{segment}`` stands for the segment's name); None
        while the table is empty."""
        columns = ", ".join([*(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema.fields), *more])
        selects = []
        for segment in self.segments():
            name = f"'{segment['name']}'"
            struck = self._struck([segment], name)
            where = f" WHERE NOT coalesce({struck}, false)" if struck else ""
            if segment["rows"]:
                selects.append(f"SELECT {columns.replace('{segment}', name)} FROM parquet.`{self.path}/data/part_of={segment['name']}`{where}")
        return " UNION ALL ".join(selects) or None


class MergedTable:
    """Keyed upserts as a log: ``INSERT … ON CONFLICT (keys) DO UPDATE SET updates`` of every batch, merged when read.

    A key's update columns come from its newest row, its other columns from its oldest. A row with a NULL in its key
    matches nothing and stays a row of its own.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], updates: Sequence[str]) -> None:
        self.table = CommittedTable(spark, path, schema)
        self.keys, self.updates = list(keys), list(updates)
        self.firsts = [f.name for f in schema.fields if f.name not in {*keys, *updates}]

    def upsert(self, df: DataFrame, at: datetime | str | None = None, keys_unique: bool = False) -> int:
        """One batch as one segment: it costs its own rows, whatever the table holds. A repeated key is an error."""
        rows = df if keys_unique else require_unique(df, self.keys)
        base = self.table.latest()
        added = self.table.write_segment("", rows, f"{base + 1:012d}-")
        return self.table.commit(base, [*self.table.segments(base), added], at)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row a known key; ``part_of`` names the order of the batches. Combined before the shuffle."""
        chosen = []
        if self.firsts:
            chosen.append(F.min_by(F.struct(*self.firsts), "part_of").alias("f"))
        if self.updates:
            chosen.append(F.max_by(F.struct(*self.updates), "part_of").alias("u"))
        columns = {**{k: k for k in self.keys}, **{c: f"f.{c}" for c in self.firsts}, **{c: f"u.{c}" for c in self.updates}}
        names = self.table.schema.fieldNames()
        known = rows.where(~any_null(self.keys)).groupBy(*self.keys).agg(*chosen or [F.count("*").alias("n")])
        return known.select(*(F.col(columns[c]).alias(c) for c in names)).union(rows.where(any_null(self.keys)).select(*names))

    def read(self, version: int | None = None) -> DataFrame:
        segments = self.table.segments(version)
        rows = self.table._scan(segments)
        return rows.select(*self.table.schema.fieldNames()) if len(segments) < 2 else self._merged(rows)

    def compact_step(self, at: datetime | str | None = None, fan_in: int = FAN_IN) -> bool:
        """Merge the newest ``fan_in`` or more neighbouring segments of like size into one; False if there are none.

        Sizes grow by ``fan_in`` from tier to tier, so n batches leave about fan_in log n segments and every row is
        rewritten about log n times. Readers see the same rows before and after.
        """
        base = self.table.latest()
        segments = self.table.segments(base)
        tier = [int(math.log(s["rows"] + 1, fan_in)) for s in segments]
        end = len(segments)
        while end > 0:
            start = end - 1
            while start > 0 and tier[start - 1] <= tier[end - 1]:
                start -= 1
            if end - start >= fan_in:
                part = segments[start:end]
                order = part[-1]["name"].split("-")[0]
                run = max(s["run"] for s in part)
                merged = self.table.write_segment(run, self._merged(self.table._scan(part)), f"{order}-")
                self.table.commit(base, [*segments[:start], merged, *segments[end:]], at)
                return True
            end -= 1
        return False

    def view_sql(self) -> str | None:
        """The merge as SQL text, for a view of the newest commit."""
        rows = self.table.view_sql("{segment} AS _segment")
        if rows is None:
            return None
        names = self.table.schema.fieldNames()
        loose = " OR ".join(f"{k} IS NULL" for k in self.keys)
        pick = {**{k: k for k in self.keys}, **{c: f"min_by(struct({c}), _segment).{c}" for c in self.firsts},
                **{c: f"max_by(struct({c}), _segment).{c}" for c in self.updates}}
        merged = f"SELECT {', '.join(f'{pick[c]} AS {c}' for c in names)} FROM ({rows}) WHERE NOT ({loose}) GROUP BY {', '.join(self.keys)}"
        return f"{merged} UNION ALL SELECT {', '.join(names)} FROM ({rows}) WHERE {loose}"


class SummedTable(MergedTable):
    """Totals by key as a log of signed changes: a key's measures are the sums of its rows, combined before the shuffle.

    Runs come in the order of their names; one that is not newer than all runs so far has been added before and is
    skipped, so a replayed batch does not count twice, also after its segment has been merged with others.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
        super().__init__(spark, path, schema, keys, [])
        self.measures = [f for f in schema.fields if f.name not in keys]

    def add(self, run: str, changes: DataFrame, at: datetime | str | None = None) -> bool:
        """Add one run's changes (any number of rows a key); False if the run is known."""
        base = self.table.latest()
        segments = self.table.segments(base)
        if segments and run <= max(s["run"] for s in segments):
            return False
        added = self.table.write_segment(run, self._merged(changes), f"{base + 1:012d}-")
        self.table.commit(base, [*segments, added], at)
        return True

    def _merged(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in self.measures]
        return rows.groupBy(*self.keys).agg(*sums).select(*self.table.schema.fieldNames())

    def view_sql(self) -> str | None:
        rows = self.table.view_sql()
        sums = ", ".join(f"CAST(sum({f.name}) AS {f.dataType.simpleString()}) AS {f.name}" for f in self.measures)
        return rows and f"SELECT {', '.join(self.keys)}, {sums} FROM ({rows}) GROUP BY {', '.join(self.keys)}"
