"""Keyed changes without a mutable table: update overlay, insert-if-absent, versions and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.verdict import row_count
from tidemark.operators.keys import first_per_key, unique_by

VERSION_ORDER = ("source_updated_at", "ingested_at", "record_hash")


def overlay(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Apply column updates: where a patch row exists its non-NULL values replace those of ``base``.

    ``patch`` holds one row per key; a repeated key is reduced to its greatest row so that an update can
    never multiply base rows.
    """
    values = [c for c in patch.columns if c != key]
    single = unique_by(patch, key, "patch_key", F.max(F.struct(*values)).alias("patch"))
    changed = [
        F.coalesce(F.col(f"patch.{c}"), F.col(c)).alias(c) if c in values else F.col(c) for c in base.columns
    ]
    return base.join(single, F.col(key) == F.col("patch_key"), "left").select(*changed)


def insert_missing(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, one row per key."""
    single = first_per_key(incoming, [key], *[F.col(c).desc() for c in incoming.columns if c != key])
    return single.join(existing.select(key), key, "left_anti").select(*incoming.columns)


def latest(df: DataFrame, key: str = "source_record_key", order: tuple[str, ...] = VERSION_ORDER) -> DataFrame:
    """Newest version of every record."""
    return first_per_key(df, [key], *[F.col(c).desc() for c in order])


def changes(old: DataFrame, new: DataFrame, key: str = "source_record_key") -> DataFrame:
    """Compare two batches by record hash: NEW, CHANGED, UNCHANGED or MISSING per key.

    Both batches are folded by key in one aggregation instead of a full outer join. Several versions of a key
    inside one batch count with their newest hash.
    """

    def side(df: DataFrame, label: str) -> DataFrame:
        return df.select(key, "record_hash", F.col("source_updated_at").alias("at"), F.lit(label).alias("side"))

    def hash_of(label: str) -> Column:
        mine = F.col("side") == label
        return F.max(F.when(mine, F.struct("at", "record_hash")))["record_hash"]

    both = side(old, "old").unionByName(side(new, "new"))
    folded = both.groupBy(key).agg(hash_of("old").alias("old_hash"), hash_of("new").alias("new_hash"))
    kind = (
        F.when(F.col("old_hash").isNull(), "NEW")
        .when(F.col("new_hash").isNull(), "MISSING")
        .when(F.col("old_hash") == F.col("new_hash"), "UNCHANGED")
        .otherwise("CHANGED")
    )
    return folded.select(key, kind.alias("change"), "old_hash", "new_hash")


def change_summary(compared: DataFrame) -> DataFrame:
    return compared.groupBy("change").agg(row_count().alias("records"))


def status_history(versions: DataFrame, key: str, status: str, changed_at: str = "source_updated_at") -> DataFrame:
    """Validity periods of a status column over successive versions of a record.

    Output: key, status, valid_from, valid_to (NULL while current), is_current. Repeated loads of a version are folded
    first. A NULL status is a state of its own. Both windows run over the versions of a key, as many as its batches.
    """
    points = versions.groupBy(key, F.col(changed_at).alias("at")).agg(F.max(status).alias("state"))
    order = Window.partitionBy(key).orderBy("at")
    before = F.lag(F.struct("state")).over(order)  # NULL only where there is no earlier version
    starts = points.withColumn("before", before).where(
        F.col("before").isNull() | ~F.col("before.state").eqNullSafe(F.col("state"))
    )
    valid_to = F.lead("at").over(order)
    return starts.select(
        key,
        F.col("state").alias(status),
        F.col("at").alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def as_of_periods(
    facts: DataFrame, key: str, at: str, periods: DataFrame, period_key: str, values: dict[str, str], most_bins: int = 64
) -> DataFrame:
    """Facts with the values of the period that holds their instant: valid_from <= at < valid_to, the last one open.

    ``periods`` are disjoint per key, such as a status history; ``values`` maps its columns to new names. Facts without a
    key, an instant or a period get NULLs, and every fact stays once. Time between the first and the last fact is cut into
    at most ``most_bins`` bins; a period is repeated for the bins it reaches into, and both sides meet by key and bin. So a
    hot key is spread over its bins, and within one over tasks by adaptive execution; no range is compared across keys.
    """
    first, last = facts.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    first, last = first or 0, last or 0
    width = max(1, -(-(last - first + 1) // most_bins))

    def bin_of(instant: Column) -> Column:
        return F.floor((F.unix_micros(instant) - F.lit(first)) / F.lit(width)).cast("int")

    start, end = F.col("valid_from"), F.col("valid_to")
    reach = periods.where(F.col(period_key).isNotNull() & start.isNotNull())
    reach = reach.where((F.unix_micros(start) <= last) & (end.isNull() | (F.unix_micros(end) > first)))
    low = F.greatest(bin_of(start), F.lit(0))
    high = F.least(F.coalesce(bin_of(end), F.lit(most_bins - 1)), F.lit(most_bins - 1))
    reach = reach.select(
        F.col(period_key).alias("period_key"), start.alias("period_start"), end.alias("period_end"),
        F.explode(F.sequence(low, high)).alias("period_bin"), *[F.col(c).alias(n) for c, n in values.items()],
    )
    held = (F.col(at) >= F.col("period_start")) & (F.col("period_end").isNull() | (F.col(at) < F.col("period_end")))
    same = (F.col(key) == F.col("period_key")) & (F.col("fact_bin") == F.col("period_bin"))
    joined = facts.withColumn("fact_bin", bin_of(F.col(at))).join(reach, same & held, "left")
    return joined.select(*facts.columns, *values.values())
