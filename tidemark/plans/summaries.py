"""Profiles that add up: a summary per batch and column, stored beside the manifest and merged without reading data again.

Counts, NULLs, minima and maxima are exact after merging. Distinct values come from HyperLogLog sketches, quantiles from KLL
sketches, both Spark's own aggregates; their errors are stated below. The exact profile is ``profile.critical_elements``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import Entity

#: Registers of a distinct sketch, as a power of two, and the relative error that 99.7 % of estimates stay within.
DISTINCT_LOG, DISTINCT_ERROR = 14, 3 * 1.04 / 2**7
#: Size of a quantile sketch, and the error of a quantile's rank that 99 % of answers stay within.
QUANTILE_SIZE, RANK_ERROR = 200, 0.0165
NUMBER = "decimal(38,6)"
SUMMARY = (
    f"source_table string, batch_id string, column_name string, row_count long, nulls long, least struct<number:{NUMBER},instant:timestamp,"
    f"text:string>, greatest struct<number:{NUMBER},instant:timestamp,text:string>, distinct_sketch binary, quantile_sketch binary"
)


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType,)):
        return "number"
    return "instant" if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else "text"


def _ends(column: str, kind: str, pick) -> Column:
    typed = {"number": NUMBER, "instant": "timestamp", "text": "string"}
    return F.struct(*[(pick(column).cast(t) if k == kind else F.lit(None).cast(t)).alias(k) for k, t in typed.items()])


def batch_summary(df: DataFrame, source_table: str, batch_id: str, columns: Sequence[str]) -> DataFrame:
    """A row per column, in one pass over the batch; every sketch has a bounded size."""
    aggregates, entries = [F.count("*").alias("row_count")], []
    for i, c in enumerate(columns):
        kind = _kind(df.schema[c].dataType)
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"), _ends(c, kind, F.min).alias(f"least_{i}"), _ends(c, kind, F.max).alias(f"greatest_{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_LOG)).alias(f"distinct_{i}"),
        ]
        sketch = F.lit(None).cast("binary")
        if kind == "number":
            aggregates.append(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_SIZE)).alias(f"quantiles_{i}"))
            sketch = F.col(f"quantiles_{i}")
        entries.append(
            F.struct(
                F.lit(source_table).alias("source_table"), F.lit(batch_id).alias("batch_id"), F.lit(c).alias("column_name"), F.col("row_count"),
                F.col(f"nulls_{i}").alias("nulls"), F.col(f"least_{i}").alias("least"), F.col(f"greatest_{i}").alias("greatest"),
                F.col(f"distinct_{i}").alias("distinct_sketch"), sketch.alias("quantile_sketch"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def summary_path(root: str, entity: Entity, batch_id: str) -> str:
    return f"{root}/_summary/{entity.name}/{batch_id}"


def store_summary(df: DataFrame, entity: Entity, root: str, batch_id: str, columns: Sequence[str] | None = None) -> None:
    """Summarise a batch into its own folder; a repeated run replaces it."""
    made = batch_summary(df, entity.source_table, batch_id, columns or entity.columns)
    made.coalesce(1).write.mode("overwrite").parquet(summary_path(root, entity, batch_id))


def merged_profile(spark: SparkSession, entity: Entity, root: str, batch_ids: Sequence[str], quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The profile of some batches together, from their summaries: a row per column.

    ``distinct_values`` is an estimate (``DISTINCT_ERROR``), the quantiles are values of that rank (``RANK_ERROR``); they are
    NULL for columns that are not numbers. Batches that repeat a record count it once per batch, as raw does.
    """
    stored = spark.read.schema(SUMMARY).parquet(*[summary_path(root, entity, b) for b in batch_ids])

    def ends(name: str, pick) -> Column:
        return F.struct(*[pick(F.col(name)[k]).alias(k) for k in ("number", "instant", "text")]).alias(name)

    folded = stored.groupBy("source_table", "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"), ends("least", F.min), ends("greatest", F.max),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.count("quantile_sketch").alias("numeric"), F.kll_merge_agg_double("quantile_sketch").alias("ranks"),
    )
    some = (F.col("numeric") > 0) & (F.col("row_count") > F.col("nulls"))
    at = [F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(float(q)))).alias(f"p{round(100 * q)}") for q in quantiles]
    return folded.select("source_table", "column_name", "row_count", "nulls", "least", "greatest", "distinct_values", *at)
