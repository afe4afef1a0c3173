"""The warehouse folder: Parquet tables as complete snapshots or as one part per run.

A snapshot table lives in ``<table>/v=<n>``; the current version is the highest one that Spark finished (it
then holds ``_SUCCESS``). A version is never overwritten while it may be read. An append table lives in
``<table>/run=<id>/v=<n>``; repeating a run adds a version to its own part, which counts once it is finished.

What was counted while a version was written is kept beside it in ``_notes.json``, so that later runs need not scan it.
A version without notes (Spark finished it, the run ended before the notes) is as good as any other; its numbers are then unknown.

A snapshot whose rows have dense keys may be kept in ranges of keys. Its next version holds the ranges that differ and names the
folders of earlier versions for the others, so one changed member rewrites one range and new members the last one. Earlier versions have to stay.

Parts may be bucketed by a key. They are then read as one bucketed table, and a join or an anti-join by that key moves the other
side only, whatever the number of parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.sources.files import child_folders, exists, join_path, read_text, write_text

_DONE = "_SUCCESS"
_NOTES = "_notes.json"


@dataclass(frozen=True)
class Buckets:
    """Key and number of the buckets of an append table. All parts need the same."""

    key: str
    number: int


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and known to the optimizer to have none, so joins with it vanish from the plan."""
    return spark.createDataFrame([], schema).where(F.lit(False))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._registered: dict[tuple, str] = {}

    def _versions(self, *folders: str) -> list[int]:
        """Finished versions of a table or part, the current one last."""
        folder = join_path(self.root, *folders)
        names = [name for name in child_folders(self.spark, folder) if name.startswith("v=")]
        return sorted(int(n.removeprefix("v=")) for n in names if exists(self.spark, join_path(folder, n, _DONE)))

    def _parts(self, table: str) -> dict[str, str]:
        """Runs that have a finished part, with its current folder."""
        names = [name for name in child_folders(self.spark, join_path(self.root, table)) if name.startswith("run=")]
        found = {name: self._versions(table, name) for name in names}
        return {n.removeprefix("run="): join_path(self.root, table, n, f"v={v[-1]}") for n, v in found.items() if v}

    def has(self, table: str) -> bool:
        return bool(self._versions(table) or self._parts(table))

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """Current snapshot. With a schema, a table that does not exist yet reads as empty."""
        versions = self._versions(table)
        if versions:
            current = join_path(self.root, table, f"v={versions[-1]}")
            ranges = (self._noted(current) or {}).get("ranges")
            paths = [join_path(self.root, table, folder) for _, folder in ranges.values()] if ranges else [current]
            return self.spark.read.parquet(*paths)
        return self._empty(table, schema)

    def replace(self, table: str, df: DataFrame, notes: Callable[[], Mapping] | None = None) -> DataFrame:
        """Write the next version and return it as read back, so that later steps start from files.

        ``notes`` is asked for what to keep beside it once it is written.
        """
        target = self._next(table)
        df.write.mode("errorifexists").parquet(target)
        self._note(target, notes)
        return self.spark.read.parquet(target)

    def replace_ranges(
        self, table: str, df: DataFrame, observed: DataFrame, key: str, size: int, notes: Callable[[], Mapping] | None = None
    ) -> list[int]:
        """Write the ranges of ``size`` keys in which ``df`` differs from the current version, and return their numbers.

        ``key`` is a whole number and never null. ``observed`` holds the same rows; it is read once, for a count and two sums of hashes per range, which
        are compared with those noted before, so nothing of the current version is read here. A version counts once its notes are complete.
        If no range differs, there is no new version.
        """
        place = F.floor(F.col(key) / F.lit(size)).cast("long")
        fields = [F.struct(F.col(c).isNull(), F.col(c)) for c in sorted(df.columns)]
        sums = [F.sum(F.xxhash64(F.lit(seed), *fields).cast("decimal(38,0)")) for seed in (1, 2)]
        marks = observed.groupBy(place.alias("place")).agg(F.concat_ws(" ", F.count("*"), *sums).alias("mark")).collect()
        before = (self.notes(table) or {}).get("ranges") or {}
        now = {str(row.place): row.mark for row in marks}
        changed = sorted(int(r) for r, mark in now.items() if before.get(r, [None])[0] != mark)
        if not changed and before.keys() == now.keys():
            return []
        target = self._next(table)
        version = target.rsplit("/", 1)[1]
        rows = df.withColumn("_range", place).where(F.col("_range").isin(changed)).repartition("_range")
        rows.write.mode("errorifexists").partitionBy("_range").parquet(join_path(target, "data"))
        folders = {str(r): f"{version}/data/_range={r}" for r in changed}
        self._note(target, notes, ranges={r: [mark, folders.get(r) or before[r][1]] for r, mark in now.items()})
        write_text(self.spark, join_path(target, _DONE), "")
        return changed

    def _next(self, *folders: str) -> str:
        folder = join_path(self.root, *folders)
        taken = [int(n.removeprefix("v=")) for n in child_folders(self.spark, folder) if n.startswith("v=")]
        return join_path(folder, f"v={max(taken, default=0) + 1}")

    def _note(self, folder: str, notes: Callable[[], Mapping] | None, **more) -> None:
        if notes or more:
            write_text(self.spark, join_path(folder, _NOTES), json.dumps({**(notes() if notes else {}), **more}, default=str))

    def _noted(self, folder: str) -> dict | None:
        text = read_text(self.spark, join_path(folder, _NOTES))
        return None if text is None else json.loads(text)

    def notes(self, table: str) -> dict | None:
        """Notes of the current snapshot; ``None`` if it has none or does not exist."""
        versions = self._versions(table)
        return self._noted(join_path(self.root, table, f"v={versions[-1]}")) if versions else None

    def part_notes(self, table: str) -> dict[str, dict | None]:
        """Notes of the current part of each run."""
        return {run: self._noted(path) for run, path in self._parts(table).items()}

    def read_appended(self, table: str, schema: str | None = None, before: str | None = None) -> DataFrame:
        """All finished parts, or those of runs other than ``before``."""
        return self._read_parts(table, schema, [p for run, p in sorted(self._parts(table).items()) if run != before])

    def read_part(self, table: str, run_id: str, schema: str | None = None) -> DataFrame:
        """The part of one run."""
        return self._read_parts(table, schema, [p for run, p in self._parts(table).items() if run == run_id])

    def _read_parts(self, table: str, schema: str | None, paths: list[str]) -> DataFrame:
        if not paths:
            return self._empty(table, schema)
        placed = {json.dumps([(self._noted(path) or {}).get(k) for k in ("buckets", "columns")]) for path in paths}
        buckets, columns = json.loads(placed.pop()) if len(placed) == 1 else (None, None)
        if buckets and columns:
            return self._read_bucketed(table, paths, Buckets(*buckets), columns)
        return self.spark.read.parquet(*paths)

    def _read_bucketed(self, table: str, paths: list[str], buckets: Buckets, fields: list[list[str]]) -> DataFrame:
        """The parts as partitions of one external table, so that Spark knows how their rows are placed. A part without rows has no files."""
        spark, key = self.spark, (table, *paths)
        if key not in self._registered:
            name = f"surestar_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{field}` {kind}" for field, kind in fields)
            spark.sql(
                f"CREATE TABLE {name} ({columns}, `_part` int) USING parquet PARTITIONED BY (`_part`) "
                f"CLUSTERED BY (`{buckets.key}`) SORTED BY (`{buckets.key}`) INTO {buckets.number} BUCKETS "
                f"LOCATION '{_quoted(join_path(self.root, table))}'"
            )
            self._registered[key] = name
            for i, path in enumerate(paths):
                spark.sql(f"ALTER TABLE {name} ADD PARTITION (`_part` = {i}) LOCATION '{_quoted(path)}'")
        return spark.table(self._registered[key]).select([field for field, _ in fields])

    def release(self) -> None:
        """Forget the tables registered for reading; their files stay. Frames read from them can't be used any more."""
        while self._registered:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._registered.popitem()[1]}")

    def append(
        self, table: str, df: DataFrame, run_id: str, notes: Callable[[], Mapping] | None = None, buckets: Buckets | None = None
    ) -> None:
        """Write the part of a run beside an earlier one, which counts until this one is finished."""
        target = self._next(table, f"run={run_id}")
        if buckets is None:
            df.write.mode("errorifexists").parquet(target)
            self._note(target, notes)
            return
        name = f"surestar_{uuid.uuid4().hex}"
        placed = df.repartition(buckets.number, buckets.key).write.format("parquet").bucketBy(buckets.number, buckets.key)
        placed.sortBy(buckets.key).option("path", target).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files of a table with a path of its own stay
        columns = [[field.name, field.dataType.simpleString()] for field in df.schema.fields]
        self._note(target, notes, buckets=[buckets.key, buckets.number], columns=columns)

    def _empty(self, table: str, schema: str | None) -> DataFrame:
        if schema is None:
            raise FileNotFoundError(f"table {table} does not exist in {self.root}")
        return empty_table(self.spark, schema)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
