"""Stamp source rows with the nine lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import record_hash, record_key
from tidemark.schemas import SCHEMA_VERSION, SOURCE_SYSTEM, Entity


def with_lineage(
    df: DataFrame,
    entity: Entity,
    batch_id: str | Column,
    ingested_at: Column,
    source_system: str = SOURCE_SYSTEM,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Source columns in declared order, followed by the lineage columns and those to ``keep``.

    ``ingested_at`` is one instant per run, captured by the caller, so a retried task stamps the same value.
    """
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.select(
        *entity.columns,
        batch.alias("migration_batch_id"),
        F.lit(source_system).alias("source_system"),
        F.lit(entity.source_table).alias("source_table"),
        record_key(entity.schema, entity.key).alias("source_record_key"),
        F.col("updated_at").alias("source_updated_at"),
        ingested_at.cast("timestamp").alias("ingested_at"),
        record_hash(entity.schema, entity.payload, entity.blank_when_null).alias("record_hash"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(False).alias("is_deleted"),
        *keep,
    )
