"""Incremental extraction with the compound checkpoint (updated_at, record key), batch and stream."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.raw import PARTITION, replace_batch
from tidemark.sources.readers import path_exists


@dataclass(frozen=True)
class Checkpoint:
    """The last extracted position. ``key`` is typed: text order of numbers would skip records.

    A composite key is a tuple, in the order of the key columns.
    """

    updated_at: Any
    key: Any


def _columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _typed(df: DataFrame, column: str, value: Any) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def _position(df: DataFrame, key: str | Sequence[str], checkpoint: Checkpoint) -> tuple[Column, Column]:
    """The key of a row and that of the checkpoint, comparable in the order of the key columns."""
    names = _columns(key)
    values = (checkpoint.key,) if isinstance(key, str) else tuple(checkpoint.key)
    if len(names) == 1:
        return F.col(names[0]), _typed(df, names[0], values[0])
    return F.struct(*names), F.struct(*[_typed(df, n, v).alias(n) for n, v in zip(names, values, strict=True)])


def _is_after(df: DataFrame, updated_at: str, key: str | Sequence[str], checkpoint: Checkpoint) -> tuple[Column, Column]:
    at, (own, last) = _typed(df, updated_at, checkpoint.updated_at), _position(df, key, checkpoint)
    return F.col(updated_at) >= at, (F.col(updated_at) > at) | (own > last)


def after(df: DataFrame, updated_at: str, key: str | Sequence[str], checkpoint: Checkpoint | None) -> DataFrame:
    """Rows behind the checkpoint in (updated_at, key) order; all rows when there is none.

    The leading comparison on the timestamp alone lets parquet skip row groups and JDBC use the index on
    (updated_at, key); the second one settles the rows that share the checkpoint's timestamp. Rows that cannot be placed
    are in neither part, see ``unplaced``.
    """
    if checkpoint is None:
        return df
    recent, behind = _is_after(df, updated_at, key, checkpoint)
    return df.where(recent).where(behind)


def unplaced(df: DataFrame, updated_at: str, key: str | Sequence[str], checkpoint: Checkpoint | None) -> DataFrame:
    """Rows of which no position says whether they were extracted: no timestamp, or its time without a key.

    They have a lane of their own: what raw does not hold yet of them is new. Without a checkpoint there are none, since
    ``after`` takes the whole table.
    """
    if checkpoint is None:
        return df.limit(0)
    recent, behind = _is_after(df, updated_at, key, checkpoint)
    return df.where((recent & behind).isNull())


def upto(df: DataFrame, updated_at: str, key: str | Sequence[str], checkpoint: Checkpoint) -> DataFrame:
    """The complement of ``after``: rows at or before the checkpoint."""
    at, (own, last) = _typed(df, updated_at, checkpoint.updated_at), _position(df, key, checkpoint)
    return df.where(F.col(updated_at) <= at).where((F.col(updated_at) < at) | (own <= last))


def next_checkpoint(slice_: DataFrame, updated_at: str, key: str | Sequence[str]) -> Checkpoint | None:
    """Greatest (updated_at, key) of a slice; None when it is empty. Fetches one row."""
    top = slice_.agg(F.max(F.struct(updated_at, *_columns(key))).alias("top")).first().top
    if top is None:
        return None
    return Checkpoint(top[0], top[1] if isinstance(key, str) else tuple(top[1:]))


def extract_control(
    slice_: DataFrame, source_table: str, updated_at: str, key: str | Sequence[str], batch_id: str, now: Column
) -> DataFrame:
    """The ledger row that stores the position reached by a slice; the parts of a composite key are joined by a pipe."""
    names = _columns(key)
    text = F.concat_ws("|", *[F.col("top")[n].cast("string") for n in names])
    return slice_.agg(F.max(F.struct(updated_at, *names)).alias("top")).select(
        F.lit(source_table).alias("source_table"),
        F.col("top")[updated_at].alias("last_watermark_ts"),
        F.when(F.col("top").isNotNull(), text).alias("last_watermark_key"),
        F.lit(batch_id).alias("last_successful_batch_id"),
        now.alias("updated_at"),
    )


def stored_checkpoint(control: DataFrame, source_table: str, schema: T.StructType, key: str | Sequence[str]) -> Checkpoint | None:
    """The typed position that the newest control row of a table holds; None if there is none yet. Fetches one row."""
    names = _columns(key)
    part = F.split("last_watermark_key", r"\|")
    typed = [F.get(part, i).cast(schema[n].dataType).alias(n) for i, n in enumerate(names)]
    rows = control.where((F.col("source_table") == source_table) & F.col("last_watermark_ts").isNotNull())
    row = rows.orderBy(F.col("updated_at").desc()).select("last_watermark_ts", *typed).first()
    if row is None:
        return None
    return Checkpoint(row[0], row[1] if isinstance(key, str) else tuple(row[1:]))


class ForeignBatches(RuntimeError):
    """Raw holds batches of another streaming query under this prefix."""


def stream_to_raw(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    raw_path: str,
    checkpoint_path: str,
    stamp: Callable[[DataFrame, str], DataFrame],
    file_glob: str = "*.parquet",
    max_files_per_trigger: int = 1000,
    batch_prefix: str = "stream",
) -> None:
    """Append arriving files to raw, one migration batch per micro-batch, until the input is drained.

    ``stamp`` adds the lineage columns for a batch id. The id holds the persistent id of the streaming query and the
    number of the micro-batch, so a replayed micro-batch overwrites only its own partition, which makes the sink
    exactly-once after a failure. A query that lost its progress folder has another id and begins anew; it is refused if
    raw holds batches under this prefix, which it would load a second time.
    """
    arriving = arriving_files(spark, source_path, schema, file_glob, max_files_per_trigger)

    def write(rows: DataFrame, batch_id: str) -> None:
        replace_batch(stamp(rows, batch_id), raw_path)

    drain(arriving, raw_path, checkpoint_path, batch_prefix, write)


def arriving_files(
    spark: SparkSession, source_path: str, schema: T.StructType, file_glob: str, max_files_per_trigger: int
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_path)
    )


def drain(
    arriving: DataFrame, raw_path: str, checkpoint_path: str, batch_prefix: str, write: Callable[[DataFrame, str], None]
) -> None:
    """Hand every micro-batch to ``write`` with its batch id until the input is drained; see ``stream_to_raw`` for the ids."""
    spark, started, own = arriving.sparkSession, threading.Event(), {}

    def take(rows: DataFrame, number: int) -> None:
        started.wait()
        prefix = f"{batch_prefix}-{own['id']}-"
        if "checked" not in own:
            _refuse_foreign(spark, raw_path, batch_prefix, prefix)
            own["checked"] = True
        write(rows, f"{prefix}{number:08d}")

    query = (
        arriving.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    own["id"] = query.id
    started.set()
    query.awaitTermination()


def _refuse_foreign(spark: SparkSession, raw_path: str, batch_prefix: str, prefix: str) -> None:
    """Only the names of partitions are compared."""
    if not path_exists(spark, raw_path):
        return
    stored = spark.read.parquet(raw_path).select(PARTITION).distinct()
    other = stored.where(F.col(PARTITION).startswith(f"{batch_prefix}-") & ~F.col(PARTITION).startswith(prefix)).first()
    if other:
        raise ForeignBatches(f"{raw_path} holds {other[0]}, written by another query")


def rows_per_stream_batch(spark: SparkSession, raw_path: str) -> DataFrame:
    return spark.read.parquet(raw_path).groupBy(PARTITION).count()
