"""Tables as plain Parquet folders.

Every write goes to a folder of its own, and counts from the moment on that one small row in the
pointer table names it. The row says what the folder is: a ``full`` load, an ``append``, a ``replace``
of the partitions that it holds, or a ``compact`` copy of stated folders. What a table holds follows
from these rows alone: :func:`live_parts`. So a crash at any point leaves the published state, readers
see a write in full or not at all, and of two writers neither touches the other's files. Rows are
ordered by a number that follows the largest one read, not by a clock. A compaction counts for a
partition only if all that it copied still counts, so what is appended or replaced beside it stays.

Folders that don't count any more are removed by :meth:`LakeTable.vacuum`, once they were superseded
for as long as the caller says.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta, timezone
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType, TimestampType

from clientlens.schemas import align_to_schema

_POINTER = (
    StructType()
    .add("number", LongType())
    .add("kind", StringType())
    .add("folder", StringType())
    .add("parts", ArrayType(StringType()))
    .add("over", ArrayType(StringType()))
    .add("published_at", TimestampType())
    .add("run_ts", TimestampType())
    .add("batch_id", StringType())
)
#: Files of a partition that are worth a rewrite, and the size that files should have.
MANY_FILES, FILE_BYTES = 4, 128 << 20
#: How long a superseded folder stays for its readers.
KEPT = timedelta(days=7)
_LOAD, _MONTH, _BUCKET = "_load", "_month", "_bucket"
Part = tuple[str, str]


def live_parts(entries: Iterable[Row]) -> tuple[list[Part], dict[Part, datetime]]:
    """The (folder, partition) pairs that count after all pointer rows, and since when others don't."""
    live: dict[Part, None] = {}
    dead: dict[Part, datetime] = {}

    def drop(pairs: list[Part], at: datetime) -> None:
        for pair in pairs:
            del live[pair]
            dead[pair] = at

    for entry in sorted(entries, key=lambda e: (e.number, e.folder)):
        parts = list(entry.parts)
        if entry.kind == "full":
            drop(list(live), entry.published_at)
        elif entry.kind == "replace":
            drop([pair for pair in live if pair[1] in set(parts)], entry.published_at)
        elif entry.kind == "compact":
            copied: dict[str, list[Part]] = {}
            for name in entry.over:
                folder, part = name.split("/", 1)
                copied.setdefault(part, []).append((folder, part))
            whole = [part for part in parts if all(pair in live for pair in copied.get(part, ()))]
            drop([pair for part in whole for pair in copied.get(part, ())], entry.published_at)
            dead |= {(entry.folder, part): entry.published_at for part in parts if part not in whole}
            parts = whole
        live |= dict.fromkeys((entry.folder, part) for part in parts)
    return list(live), dead


class LakeTable:
    """One table. ``partition_by`` names a column whose values become folders; with ``by_month`` it is
    a date, and its months become folders, in which the rows of a file are in order of the date; with
    ``buckets`` it is a key, and its rows are dealt by a hash to so many folders, in order of the key.

    ``lookup`` names a column by which single rows are looked for: files are in its order within a
    partition and carry Bloom filters of it, so a lookup skips the row groups that can't hold the value.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        partition_by: str | None = None,
        by_month: bool = False,
        buckets: int = 0,
        lookup: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by
        self.by_month = by_month
        self.buckets = buckets
        self.lookup = lookup
        #: The column that only folder names hold.
        self.derived = _MONTH if by_month else _BUCKET if buckets else None

    # --- what counts --------------------------------------------------------------------------

    def entries(self) -> list[Row]:
        """All pointer rows, one for each write."""
        try:
            return self.spark.read.schema(_POINTER).parquet(f"{self.path}/published").collect()
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def published(self) -> dict | None:
        """Folder, run time and batch of the latest full load; None if there was none."""
        full = [e for e in self.entries() if e.kind == "full"]
        if not full:
            return None
        latest = max(full, key=lambda e: (e.number, e.folder))
        micros = None if latest.run_ts is None else round(latest.run_ts.astimezone(timezone.utc).timestamp() * 1_000_000)
        return {"folder": latest.folder, "run_ts": micros, "batch_id": latest.batch_id}

    def exists(self) -> bool:
        return bool(self.entries())

    def part_of(self) -> Column:
        """The partition of a row."""
        column = F.col(self.partition_by)
        if self.buckets:
            # With the number of buckets in it: other numbers of buckets have other names.
            return F.concat(F.lit(f"{self.buckets}-"), F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("string"))
        return F.date_format(column, "yyyy-MM") if self.by_month else column

    def touched(self, keys: DataFrame) -> DataFrame | None:
        """The stored rows of all buckets that hold one of the keys, or would; None where the table isn't
        dealt to its present number of buckets."""
        entries = self.entries()
        live = live_parts(entries)[0]
        prefix = f"{_BUCKET}={self.buckets}-"
        if not self.buckets or not all(part.startswith(prefix) for _, part in live):
            return None
        hit = {f"{_BUCKET}={r[0]}" for r in keys.select(self.part_of()).distinct().collect()}
        return self._load([pair for pair in live if pair[1] in hit], entries)

    def _load(self, parts: Sequence[Part], entries: Iterable[Row] = ()) -> DataFrame:
        """The rows of some partitions; whole folders are read as such."""
        if not parts:
            return align_to_schema(self.spark.sql("SELECT 1 AS x WHERE false"), self.schema)
        wanted: dict[str, list[str]] = {}
        for folder, part in parts:
            wanted.setdefault(folder, []).append(part)
        held = {e.folder: len(e.parts) for e in entries}
        paths = []
        for folder, own in wanted.items():
            whole = not self.partition_by or len(own) == held.get(folder)
            paths += [self._folder(folder)] if whole else [f"{self._folder(folder)}/{part}" for part in own]
        stored = StructType([*self.schema.fields]).add(_LOAD, StringType())
        if self.derived:
            stored = stored.add(self.derived, StringType())
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*self.schema.names)

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/{_LOAD}={name}"

    def _rows(self, folder: str) -> DataFrame:
        """The rows of one written folder, whether it counts or not."""
        return self._load([(folder, part) for part in self._parts(folder)])

    def read(self) -> DataFrame:
        """The rows of the table; a table that was never loaded is an error."""
        entries = self.entries()
        if not entries:
            raise ValueError(f"{self.path} was never loaded")
        return self._load(live_parts(entries)[0], entries)

    def state(self) -> DataFrame:
        """The rows of the table, none before its first load."""
        entries = self.entries()
        return self._load(live_parts(entries)[0], entries)

    def difference(self, old: int, new: int) -> tuple[DataFrame, DataFrame]:
        """The rows that only the state after write ``old``, or only that after ``new``, reads.

        Folders never change, so what lies in the same partition of the same folder in both states is
        equal and isn't read. A state that was vacuumed can't be read any more.
        """
        entries = self.entries()
        before, after = (live_parts([e for e in entries if e.number <= n])[0] for n in (old, new))
        return self._load(sorted({*before} - {*after}), entries), self._load(sorted({*after} - {*before}), entries)

    # --- files --------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _parts(self, folder: str) -> list[str]:
        """The partitions that a written folder holds; one without a name if the table has none."""
        if not self.partition_by:
            return [""]
        store, place = self._hadoop(self._folder(folder))
        names = [status.getPath().getName() for status in store.listStatus(place) if status.isDirectory()]
        return sorted(name for name in names if "=" in name)

    def _files(self, pair: Part) -> tuple[int, int]:
        """How many data files a partition of a folder has, and their bytes."""
        store, place = self._hadoop("/".join(filter(None, (self._folder(pair[0]), pair[1]))))
        sizes = [s.getLen() for s in store.listStatus(place) if s.isFile() and s.getPath().getName().endswith(".parquet")]
        return len(sizes), sum(sizes)

    # --- writing ------------------------------------------------------------------------------

    def draft(self, df: DataFrame, gather: bool = True, **figures: Column) -> tuple[str, dict]:
        """Write a folder that doesn't count yet, in one pass; gives its name, and ``rows`` and the
        ``figures`` asked for.

        A partition is gathered into files of even size; a large one is written by many tasks. Without
        ``gather`` each task writes its own rows, for frames that have one partition: they need no shuffle.
        """
        folder = uuid.uuid4().hex
        watch = Observation()
        rows = align_to_schema(df, self.schema).observe(watch, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in figures.items()))
        by = self.derived or self.partition_by
        if self.derived:
            rows = rows.withColumn(by, self.part_of())
        if by and gather:
            rows = rows.hint("rebalance", by)
        order = [*dict.fromkeys(c for c in (by, self.lookup, self.derived and self.partition_by) if c)]
        if self.derived or self.lookup:
            rows = rows.sortWithinPartitions(*order)
        writer = rows.write.partitionBy(by) if by else rows.write
        if self.lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.lookup}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(self._folder(folder))
        try:
            return folder, watch.get
        except Exception as error:  # noqa: BLE001 - py4j has no error of its own for it
            if "assertion failed" not in str(error):
                raise
            # Spark found the frame to be empty and left the counting out of its plan.
            return folder, dict.fromkeys(("rows", *figures), 0)

    def publish(
        self,
        folder: str,
        run_ts: datetime | None = None,
        batch_id: str | None = None,
        kind: str = "full",
        over: Sequence[Part] = (),
    ) -> None:
        """Let a written folder count."""
        number = 1 + max((e.number for e in self.entries()), default=0)
        copied = ["/".join(pair) for pair in over]
        row = (number, kind, folder, self._parts(folder), copied, datetime.now(timezone.utc), run_ts, batch_id)
        entry = self.spark.createDataFrame([row], _POINTER)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/published")

    def _store(
        self, df: DataFrame, kind: str, run_ts: datetime | None = None, batch_id: str | None = None, gather: bool = True
    ) -> int:
        folder, figures = self.draft(df, gather)
        self.publish(folder, run_ts, batch_id, kind)
        return figures["rows"]

    def replace(
        self, df: DataFrame, run_ts: datetime | None = None, batch_id: str | None = None, gather: bool = True
    ) -> int:
        """The frame becomes the whole table; returns its rows."""
        return self._store(df, "full", run_ts, batch_id, gather)

    def append(self, df: DataFrame) -> int:
        return self._store(df, "append")

    def overwrite_partitions(self, df: DataFrame) -> int:
        """The frame becomes the whole content of the partitions that it has rows for."""
        return self._store(df, "replace")

    # --- upkeep -------------------------------------------------------------------------------

    def compact(self) -> int:
        """Copy the partitions that lie in many small files into few; returns the rows copied.

        Files are counted by listing them. Rows that others publish meanwhile are not touched; where
        they replaced what was copied, the copy doesn't count.
        """
        entries = self.entries()
        by_part: dict[str, list[Part]] = {}
        for pair in live_parts(entries)[0]:
            by_part.setdefault(pair[1], []).append(pair)
        chosen: list[Part] = []
        for pairs in by_part.values():
            sizes = [self._files(pair) for pair in pairs]
            n, size = (sum(s[i] for s in sizes) for i in (0, 1))
            if n > MANY_FILES and n > 2 * ceil(size / FILE_BYTES):
                chosen += pairs
        if not chosen:
            return 0
        folder, figures = self.draft(self._load(chosen, entries))
        self.publish(folder, kind="compact", over=chosen)
        return figures["rows"]

    def vacuum(self, before: datetime | None = None) -> int:
        """Delete what stopped counting before a time, and folders of that age that never counted, as
        failed runs leave them; returns the number of deletions."""
        before = before or datetime.now(timezone.utc) - KEPT
        limit = before.timestamp()
        entries = self.entries()
        live, dead = live_parts(entries)
        deleted = 0
        for (name, part), since in dead.items():
            if since.timestamp() < limit:
                store, place = self._hadoop("/".join(filter(None, (self._folder(name), part))))
                deleted += store.delete(place, True)
        known = {e.folder for e in entries}
        store, place = self._hadoop(f"{self.path}/data")
        for status in store.listStatus(place) if store.exists(place) else ():
            name = status.getPath().getName().partition("=")[2]
            if name not in known and status.getModificationTime() < limit * 1000:
                deleted += store.delete(status.getPath(), True)
        return deleted


class Dimension:
    """A type 2 dimension: the versions after the latest run, and an archive of closed ones.

    A load holds the current versions and those that its own run closed. The next run moves these to
    the archive, a partition for each run, before it publishes its own load; readers take from the
    archive what was closed before the published run. So closed history is never rewritten, and a
    crash at any point leaves the published state readable and the retry idempotent.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.versions = LakeTable(spark, f"{path}/versions", schema, "is_current")
        self.archive = LakeTable(spark, f"{path}/closed", schema, "effective_to")

    def published(self) -> dict | None:
        return self.versions.published()

    def exists(self) -> bool:
        return self.published() is not None

    def _history(self, latest: DataFrame, pointer: dict | None) -> DataFrame:
        if pointer is None or not self.archive.exists():
            return latest
        closed = self.archive.read().filter(F.col("effective_to") < F.timestamp_micros(F.lit(pointer["run_ts"])))
        return latest.unionByName(closed)

    def read(self) -> DataFrame:
        """All versions; a dimension that was never loaded is an error."""
        return self._history(self.versions.read(), self.published())

    def state(self) -> DataFrame:
        return self._history(self.versions.state(), self.published())

    def current(self) -> DataFrame:
        return self.versions.state().filter("is_current")

    def move_closed(self) -> None:
        """Archive what the published run closed."""
        closed = self.versions.state().filter("NOT is_current")
        self.archive.overwrite_partitions(closed)

    def compact(self) -> int:
        return self.archive.compact() if self.archive.exists() else 0

    def vacuum(self, before: datetime | None = None) -> int:
        return self.versions.vacuum(before) + self.archive.vacuum(before)


class Lake:
    """The tables of all layers below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(
        self,
        layer: str,
        name: str,
        schema: StructType,
        partition_by: str | None = None,
        by_month: bool = False,
        buckets: int = 0,
        lookup: str | None = None,
    ) -> LakeTable:
        return LakeTable(self.spark, self.path(layer, name), schema, partition_by, by_month, buckets, lookup)

    def dimension(self, layer: str, name: str, schema: StructType) -> Dimension:
        return Dimension(self.spark, self.path(layer, name), schema)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"
