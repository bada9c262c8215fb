"""Session set-up and the shared folder that long jobs cut their lineage in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on, plus the adaptive features the plans lean on.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A skewed FK join feeds further operators; split it even if that adds an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches that go to Python end after so many bytes, so long texts do not add up to the default of 64 MB.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


# Bytes of input files that a reduce task stands for, before adaptive execution joins small ones.
BYTES_PER_REDUCER = 2 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Rows that are sorted by their group already are summed as they stream, by one aggregate instead of two hash tables.
SORTED_SUMS = "spark.sql.execution.replaceHashWithSortAgg"
# For jobs over large tables: Zstandard halves hashes in hex, and a task that unfolds, sorts or groups rows starts from
# 32 MB of a file or 16 MB of a shuffle, which is several times that in memory.
SIZED_SETTINGS = {
    SORTED_SUMS: "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Shuffle files go when the action that wrote them ends, not when the driver happens to collect its garbage.
BRIEF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def sized_for(spark: SparkSession, paths: Iterable[str]) -> SparkSession:
    """Let the reduce tasks of a session grow in number with the files it is going to read, not in size.

    Only the number that adaptive execution starts from is set, never below the session's own; it joins what turns out small.
    """
    total = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(target).getLength() if files.exists(target) else 0
    for key, value in SIZED_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(INITIAL_PARTITIONS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BYTES_PER_REDUCER))
    return spark


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """For jobs of many actions over large tables, none of which runs a plan twice: only the running one keeps shuffle files."""
    before = spark.conf.get(BRIEF_SHUFFLES, "false")
    spark.conf.set(BRIEF_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(BRIEF_SHUFFLES, before)


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached block the files outlive their executors, and unlike ``checkpoint`` the plan
    above them keeps column pruning and predicate pushdown.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
