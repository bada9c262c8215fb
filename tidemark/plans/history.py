"""A status history kept by increments: versions in any order open, close, split or join the periods stored.

Three tables lie under one snapshot record. ``points`` are the known versions as (key, instant, state), in cells of a key
bucket and a stretch of time. ``runs`` are the first points of equal states in a row within a cell. ``periods`` follow from
the runs of a key, and lie in its bucket. Every change of state begins a run, so the runs tell the periods without the
versions; and what a late version splits is known from the points of its own cell.

An increment rewrites the points and runs of the cells it has versions in. Versions that only confirm a state change no
run, and then no period is written. Where runs changed, the periods of their buckets are built from the runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import status_history
from tidemark.plans.snapshots import Files, Snapshot, Snapshots, read_folders, with_folder
from tidemark.schemas import Entity
from tidemark.session import materialise

POINTS, RUNS, PERIODS = "points", "runs", "periods"
CELL, BUCKET = T.StructField("cell", T.LongType()), T.StructField("bucket", T.LongType())
DAY = 86_400_000_000
#: The stretch of versions without an instant, before all others.
TIMELESS = -1_000_000
#: Tasks that write one cell, so that a hot one is not written by a single task.
WRITERS = 8
#: Points spread over so many folders are rewritten whole by the next increment.
MOST_FOLDERS = 64


class History:
    """The history of one column of an entity below ``root``. Buckets and stretch (in days) are fixed for its life."""

    def __init__(self, spark: SparkSession, root: str, entity: Entity, status: str, buckets: int = 64, days: int = 90):
        self.spark, self.root, self.key, self.status = spark, root.rstrip("/"), entity.key[0], status
        self.buckets, self.days = buckets, days
        self.snapshots = Snapshots(spark, f"{self.root}/snapshots")
        key, state = (entity.schema[c].dataType for c in (self.key, status))
        instant = T.TimestampType()
        point = T.StructType().add("key", key).add("at", instant).add("state", state)
        period = T.StructType().add("key", key).add("state", state).add("valid_from", instant).add("valid_to", instant)
        self._schemas = {POINTS: point, RUNS: point, PERIODS: period.add("is_current", T.BooleanType())}

    def _cell(self) -> Column:
        """The number of a stretch of time and a bucket; instants, not local times, so that no session's zone matters."""
        stretch = F.coalesce(F.floor(F.unix_micros("at") / F.lit(self.days * DAY)), F.lit(TIMELESS))
        return (stretch * self.buckets + F.pmod(F.xxhash64("key"), F.lit(self.buckets))).cast("bigint")

    def _read(self, files: Files, layer: str, only: Iterable[int] | None = None) -> DataFrame:
        by = BUCKET if layer == PERIODS else CELL
        return read_folders(self.spark, files.get(layer, {}), self._schemas[layer], by, only)

    def _write(self, files: Files, layer: str, rows: DataFrame, places: set[int]) -> Files:
        folder, by = f"{self.root}/data/{layer}/{uuid.uuid4().hex}", (BUCKET if layer == PERIODS else CELL).name
        when = "valid_from" if layer == PERIODS else "at"
        spread = rows.repartition(by, F.pmod(F.xxhash64(when), F.lit(WRITERS)))
        spread.write.partitionBy(by).parquet(folder)
        return with_folder(files, layer, folder, places)

    def merge(self, versions: DataFrame, label: str) -> Snapshot | None:
        """Take in versions (key, ``source_updated_at``, status), late and repeated ones too; returns the new snapshot.

        Several versions of one instant count with their greatest state, a NULL only if there is no other, as in
        ``status_history``. Versions without an instant are one that precedes all others. The driver receives the numbers
        of the cells that have new versions. Raises ``LostRace`` if another writer was faster.
        """
        before = self.snapshots.newest()
        files: Files = dict(before.files) if before else {}
        new = versions.select(F.col(self.key).alias("key"), F.col("source_updated_at").alias("at"), F.col(self.status).alias("state"))
        new = materialise(_folded(new.withColumn(CELL.name, self._cell())), "versions")
        cells = {r[0] for r in new.select(CELL.name).distinct().collect()}
        if not cells:
            return before
        if len(files.get(POINTS, {})) >= MOST_FOLDERS:
            cells |= {c for held in files[POINTS].values() for c in held}
        old_runs = self._read(files, RUNS, cells)
        points = self._read(files, POINTS, cells).unionByName(new)
        files = self._write(files, POINTS, _folded(points), cells)
        files = self._write(files, RUNS, _runs(self._read(files, POINTS, cells)), cells)
        changed = _differing_cells(old_runs, self._read(files, RUNS, cells))
        if changed:
            buckets = {c % self.buckets for c in changed}
            own = [c for held in files[RUNS].values() for c in held if c % self.buckets in buckets]
            files = self._write(files, PERIODS, self._periods(self._read(files, RUNS, own)), buckets)
        return self.snapshots.commit(before, label, files)

    def _periods(self, runs: DataFrame) -> DataFrame:
        found = status_history(runs, "key", "state", "at")
        return found.withColumn(BUCKET.name, F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("bigint"))

    def periods(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The periods as ``status_history`` gives them, as of a snapshot or the newest one."""
        snapshot = snapshot or self.snapshots.newest()
        rows = self._read(snapshot.files if snapshot else {}, PERIODS)
        return rows.select(F.col("key").alias(self.key), F.col("state").alias(self.status), "valid_from", "valid_to", "is_current")

    def sweep(self, keep: int, reading: Iterable[int] = ()) -> list[str]:
        """Remove old snapshots and the folders no other one names; see ``Snapshots.sweep``."""
        return self.snapshots.sweep(keep, f"{self.root}/data", reading)


def _folded(points: DataFrame) -> DataFrame:
    return points.groupBy("key", "at", CELL.name).agg(F.max("state").alias("state"))


def _runs(points: DataFrame) -> DataFrame:
    """The first point of equal states in a row; a window spans the versions of a key within one stretch of time."""
    before = F.lag(F.struct("state")).over(Window.partitionBy(CELL.name, "key").orderBy("at"))  # NULL only at the first
    starts = points.withColumn("before", before)
    return starts.where(F.col("before").isNull() | ~F.col("before.state").eqNullSafe(F.col("state"))).drop("before")


def _differing_cells(old: DataFrame, new: DataFrame) -> set[int]:
    """Cells whose runs came, went or changed; at most as many as the increment touches."""
    columns = ["key", "at", "state", CELL.name]
    both = old.select(*columns, F.lit(-1).alias("side")).unionByName(new.select(*columns, F.lit(1).alias("side")))
    differing = both.groupBy(*columns).agg(F.sum("side").alias("n")).where("n <> 0")
    return {r[0] for r in differing.select(CELL.name).distinct().collect()}
