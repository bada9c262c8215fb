"""Rules on a stream: every micro-batch goes through raw, verdict, core and quarantine of the bucket store.

Replayed records are held back twice. State with a watermark on the time of arrival forgets a record after
``replay_window``; by then it lies in raw, against whose rows of the same period of change the micro-batch is compared.
The watermark is on arrival and not on the record's own time, since Spark drops rows behind a watermark: late records are
ordinary here, and the newest version of a record counts whenever it comes.

The state holds 16 bytes for a record, and source columns alone travel to it; the lineage is stamped behind it. A micro-batch
is kept aside until raw holds it, and the merge reads it from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lineage import with_lineage
from tidemark.plans.ledger import FAILED, RUNNING, SUCCEEDED, Ledgers
from tidemark.plans.migration import Migration, Run, _message, _now
from tidemark.plans.snapshots import LostRace
from tidemark.plans.store import Store
from tidemark.schemas import ENTITIES
from tidemark.session import brief_shuffles, scratch_path
from tidemark.sources.raw import PARTITION, replace_batch, same_values, unseen
from tidemark.sources.readers import path_exists, remove_path
from tidemark.streaming.incremental import arriving_files, drain

#: A row equal to another in these is the same record sent again.
SAME: Sequence[str] = ("source_record_key", "record_hash", "source_updated_at")
ARRIVED, SENT = "arrived_at", "sent_record"
#: How often a micro-batch is merged anew over the snapshot of a faster writer.
RACES = 5


def stream_to_store(
    spark: SparkSession,
    name: str,
    source_path: str,
    run: Run,
    root: str,
    checkpoint_path: str,
    replay_window: str = "1 day",
    buckets: int = 256,
    file_glob: str = "*.parquet",
    max_files_per_trigger: int = 1000,
    batch_prefix: str = "stream",
) -> Store:
    """Judge arriving files of one table until the input is drained; the layers end as if all rows had come in one batch.

    Each micro-batch is a migration batch: its new rows are appended to raw, merged into the store below ``root`` and made
    visible by one snapshot, so readers see a micro-batch in all layers or in none. A failure repeats the micro-batch under
    its id, which overwrites its raw partition and leaves a snapshot that is already in place as it is. Rows that are equal
    in ``SAME`` count once; a missing key or time of change counts as a value. The store's other tables may be written by
    other streams or by ``advance``: who loses a race merges again over the newer snapshot. Rows that only a rolled back
    batch held and that come again within ``replay_window`` are taken for replays; send them through ``advance``. Long
    windows hold much state: choose the session's RocksDB state store for them.
    """
    entity, ledgers, store = ENTITIES[name], Ledgers(spark, root), Store(spark, root, buckets)
    arriving = arriving_files(spark, source_path, entity.schema, file_glob, max_files_per_trigger)
    stamped = with_lineage(arriving, entity, "", run.instant("ingested_at"))
    once = (
        stamped.select(*entity.columns, same_values(stamped, SAME).alias(SENT))
        .withColumn(ARRIVED, F.current_timestamp())
        .withWatermark(ARRIVED, replay_window)
        .dropDuplicatesWithinWatermark([SENT])
    )
    single = with_lineage(once, entity, "", run.instant("ingested_at"))

    def judge(rows: DataFrame, batch_id: str) -> None:
        job = Migration({}, replace(run, batch_id=batch_id), root, ledgers, newest_only=True)
        _judge(job, store, name, rows.withColumn(PARTITION, F.lit(batch_id)))

    with brief_shuffles(spark):  # the query's session takes it over
        drain(single, f"{root}/raw/{name}", checkpoint_path, batch_prefix, judge)
    return store


def _judge(job: Migration, store: Store, name: str, rows: DataFrame) -> None:
    batch, started = job.run.batch_id, _now()

    def note(status: str, error: str | None = None) -> None:
        ended = _now() if status != RUNNING else None
        job.ledgers.append("migration_batch", batch, "STREAM", None, None, started, ended, status, "operator", error)

    newest = store.snapshots.newest()
    if newest is not None and newest.label == batch:  # the query ended between the snapshot and its own progress
        rows.write.format("noop").mode("overwrite").save()  # state is only kept of rows that are read
    else:
        note(RUNNING)
        try:
            fresh = _load(job, name, rows)
            if not fresh.isEmpty():
                _merge(store, name, fresh, job.run)
        except Exception as error:
            note(FAILED, _message(error))
            raise
    note(SUCCEEDED)


def _load(job: Migration, name: str, rows: DataFrame) -> DataFrame:
    """Append the rows that no other visible batch of raw holds to raw; returns them as they lie there.

    The micro-batch is written first, by the query's session, and read by the caller's. Raw is read only between its
    earliest and latest time of change, which prunes row groups.
    """
    spark, path = job.spark, scratch_path(job.spark, f"arrived-{name}")
    try:
        rows.write.parquet(path)
        arrived = spark.read.schema(rows.schema).parquet(path)
        if arrived.isEmpty():
            return spark.createDataFrame([], rows.schema)
        replace_batch(_new_to_raw(job, name, arrived), job.path("raw", name))
    finally:
        remove_path(spark, path)
    return job.visible_raw(name).where(F.col(PARTITION) == job.run.batch_id)


def _new_to_raw(job: Migration, name: str, arrived: DataFrame) -> DataFrame:
    if not path_exists(job.spark, job.path("raw", name)):
        return arrived
    at = F.col("source_updated_at")
    first, last = arrived.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()  # numbers know no time zone
    near = at.isNull()
    if first is not None:
        near = near | at.between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)))
    held = job.visible_raw(name).where(F.col(PARTITION) != job.run.batch_id).where(near)
    return unseen(arrived, held, SAME)


def _merge(store: Store, name: str, fresh: DataFrame, run: Run) -> None:
    for left in reversed(range(RACES)):
        try:
            store.merge({name: fresh}, run)
            return
        except LostRace:
            if not left:
                raise
