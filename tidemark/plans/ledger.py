"""Control ledgers: batches, table runs, restart and rollback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.verdict import row_count, union_all
from tidemark.operators.keys import distinct_count, first_per_key
from tidemark.schemas import ENTITIES, EXTRACT_CONTROL, MIGRATION_BATCH, ROLLED_BACK, TABLE_RUN
from tidemark.sources.readers import path_exists
from tidemark.sources.sinks import JSON_INSTANTS

SUCCEEDED, FAILED, RUNNING = "SUCCEEDED", "FAILED", "RUNNING"
#: Longest error text a ledger row holds.
MESSAGE_CHARS = 1000


@dataclass(frozen=True)
class Ledgers:
    """The control tables below a folder. They only grow: the newest row of a key is the one that counts."""

    spark: SparkSession
    root: str

    SCHEMAS = {
        "migration_batch": MIGRATION_BATCH,
        "table_run": TABLE_RUN,
        "source_extract_control": EXTRACT_CONTROL,
        "rolled_back_batch": ROLLED_BACK,
    }

    def append(self, name: str, *row: object) -> None:
        rows = self.spark.createDataFrame([row], self.SCHEMAS[name]).coalesce(1)
        rows.write.mode("append").options(**JSON_INSTANTS).json(f"{self.root}/control/{name}")

    def read(self, name: str) -> DataFrame:
        path = f"{self.root}/control/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], self.SCHEMAS[name])
        return self.spark.read.schema(self.SCHEMAS[name]).options(**JSON_INSTANTS).json(path)

    def batches(self) -> DataFrame:
        """The state of every batch: its newest row."""
        newest = [F.col("started_at").desc(), F.col("completed_at").desc_nulls_last()]
        return first_per_key(self.read("migration_batch"), ["batch_id"], *newest)

    def positions(self) -> DataFrame:
        """How far each source table has been extracted, as far as what was extracted can still be seen.

        A rollback hides what lies between the position before the batch and its own, so every position that stood at that
        time and is not older than the batch's is void: the next extract begins where the batch began. Rows that later
        batches hold are then extracted again and count with their newest version.
        """
        stored = self.read("source_extract_control").where(F.col("last_watermark_ts").isNotNull())
        if not path_exists(self.spark, f"{self.root}/control/rolled_back_batch"):
            return first_per_key(stored, ["source_table"], F.col("updated_at").desc())
        rolled = self.read("rolled_back_batch").select("batch_id", "rolled_back_at")
        hidden = stored.join(rolled, F.col("last_successful_batch_id") == F.col("batch_id")).select(
            F.col("source_table").alias("hidden_table"), F.col("batch_id").alias("hidden_batch"),
            F.col("updated_at").alias("hidden_from"), "rolled_back_at",
        )
        stood = F.col("updated_at").between(F.col("hidden_from"), F.col("rolled_back_at"))
        own = F.col("last_successful_batch_id") == F.col("hidden_batch")  # whatever the clocks said
        void = (F.col("source_table") == F.col("hidden_table")) & (own | stood)
        return first_per_key(stored.join(hidden, void, "left_anti"), ["source_table"], F.col("updated_at").desc())

    def finished(self, batch_id: str) -> set[str]:
        """Tables of a batch whose newest run succeeded; at most one row per migrated table is fetched."""
        runs = self.read("table_run").where(F.col("batch_id") == batch_id)
        newest = first_per_key(runs, ["table_name"], F.col("completed_at").desc())
        return {r.table_name for r in newest.where(F.col("status") == SUCCEEDED).collect()}

    def rolled_back(self) -> list[str]:
        """Ids of rolled back batches, a handful."""
        return sorted(r.batch_id for r in self.read("rolled_back_batch").select("batch_id").distinct().collect())


def without(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    return rows.where(~F.col(column).isin(*values)) if values else rows


def table_runs(
    batch_id: str,
    sources: dict[str, DataFrame | int],
    landed: dict[str, DataFrame | int],
    raw: dict[str, DataFrame],
    rejected: dict[str, DataFrame],
    started_at: Column,
    completed_at: Column,
) -> DataFrame:
    """One ledger row per table: source, extracted, loaded and rejected rows and the resulting status.

    A table counted before may be given by its number of rows.
    """
    counts = []
    for name in sources:
        for label, df in (("source", sources[name]), ("extracted", landed[name]), ("loaded", raw[name])):
            if isinstance(df, int):
                number = raw[name].sparkSession.range(1).select(F.lit(df).cast("bigint").alias("n"))
            else:
                number = df.agg(row_count().alias("n"))
            counts.append(number.select(F.lit(name).alias("t"), F.lit(label).alias("k"), "n"))
        lost = distinct_count(rejected[name], "source_record_key", "n")
        counts.append(lost.select(F.lit(name).alias("t"), F.lit("rejected").alias("k"), "n"))

    def pick(label: str) -> Column:
        return F.max(F.when(F.col("k") == label, F.col("n"))).alias(f"{label}_rows")

    per_table = union_all(counts).groupBy("t").agg(*[pick(k) for k in ("source", "extracted", "loaded", "rejected")])
    complete = (F.col("source_rows") == F.col("extracted_rows")) & (F.col("extracted_rows") == F.col("loaded_rows"))
    names = F.create_map(*[x for n in sources for x in (F.lit(n), F.lit(ENTITIES[n].source_table))])
    return per_table.select(
        F.lit(batch_id).alias("batch_id"),
        F.element_at(names, F.col("t")).alias("table_name"),
        "source_rows",
        "extracted_rows",
        "loaded_rows",
        "rejected_rows",
        started_at.cast("timestamp").alias("started_at"),
        completed_at.cast("timestamp").alias("completed_at"),
        F.when(complete, SUCCEEDED).otherwise(FAILED).alias("status"),
        F.when(~complete, "row counts differ").alias("error_message"),
    ).select(*TABLE_RUN.fieldNames())


def batch_ledger(runs: DataFrame, migration_type: str, initiated_by: str) -> DataFrame:
    """One row per batch folded from its table runs; a batch succeeds when all its tables did."""
    return runs.groupBy("batch_id").agg(
        F.lit(migration_type).alias("migration_type"),
        F.min("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"),
        F.when(F.bool_and(F.col("status") == SUCCEEDED), SUCCEEDED).otherwise(FAILED).alias("status"),
        F.lit(initiated_by).alias("initiated_by"),
        F.max("error_message").alias("error_message"),
    )


def pending(planned: DataFrame, runs: DataFrame) -> DataFrame:
    """Planned (batch_id, table_name) pairs that have not succeeded, i.e. what a restart still has to do."""
    pair = ["batch_id", "table_name"]
    marked = planned.select(*pair, F.lit(False).alias("is_done"), F.lit(True).alias("is_planned")).unionByName(
        runs.select(*pair, (F.col("status") == SUCCEEDED).alias("is_done"), F.lit(False).alias("is_planned"))
    )
    folded = marked.groupBy(*pair).agg(F.bool_or("is_done").alias("done"), F.bool_or("is_planned").alias("planned"))
    return folded.where("planned AND NOT done").select(*pair)
