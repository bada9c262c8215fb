"""Batch sources: parquet, CSV with a header, and partitioned JDBC reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import Entity


class EmptyExtract(RuntimeError):
    """An extract returned no rows."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system its path belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written, with all it holds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _relaxed(entity: Entity):
    """The declared schema without NOT NULL: files do not enforce it, the audits do."""
    return type(entity.schema)([type(f)(f.name, f.dataType, True) for f in entity.schema.fields])


def read_parquet(spark: SparkSession, entity: Entity, path: str) -> DataFrame:
    """Landing files with the declared schema; a missing path raises at analysis."""
    return spark.read.schema(_relaxed(entity)).parquet(path)


def read_csv_as(spark: SparkSession, schema: T.StructType, path: str, line_breaks: bool = True) -> DataFrame:
    """CSV with a header in the usual dialect: quotes inside a quoted field are doubled, an empty field is NULL.

    ``line_breaks`` lets quoted fields hold line breaks. A file is then read by one task, so keep files small; without
    it a file is split at line ends.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("emptyValue", None)
    return reader.option("escape", '"').option("multiLine", line_breaks).csv(path)


def read_csv(spark: SparkSession, entity: Entity, path: str, line_breaks: bool = True) -> DataFrame:
    """A table of the bank from CSV; True/False parse as boolean."""
    return read_csv_as(spark, _relaxed(entity), path, line_breaks).select(*entity.columns)


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a range-partitioned read; ``partitions`` bounds the connections on the source."""
    if partitions < 1 or lower > upper:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper + 1),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, entity: Entity, url: str, partitions: int, **credentials: str) -> DataFrame:
    """Whole source table, read in parallel by ranges of its leading key.

    The key range comes from one MIN/MAX query that the database answers from its primary-key index.
    """
    key = entity.key[0]
    bounds = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {entity.source_table}) AS key_range"
    reader = spark.read.format("jdbc").options(**credentials)
    low, high = reader.options(url=url, dbtable=bounds).load().first()
    if low is None:
        raise EmptyExtract(f"no rows in {entity.source_table}")
    options = jdbc_options(url, entity.source_table, key, int(low), int(high), partitions)
    rows = spark.read.format("jdbc").options(**credentials, **options).load()
    return extract(rows, entity)


def extract(df: DataFrame, entity: Entity) -> DataFrame:
    """The declared columns in declared types; no ordering, the manifest needs none."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in entity.schema.fields])
