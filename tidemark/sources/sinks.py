"""Sinks: CSV with a header, JSON Lines, table replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import canonical_text
from tidemark.sources.readers import path_exists


#: Instants in JSON files with all their digits; Spark's default keeps milliseconds only.
JSON_INSTANTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Records of one CSV file.
CSV_RECORDS = 500_000
VERSIONS = "number long, folder string, label string"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header line, booleans as True/False, NULL as an empty field, quotes in quoted fields doubled."""
    columns = [
        F.initcap(F.col(f.name).cast("string")).alias(f.name)
        if isinstance(f.dataType, T.BooleanType)
        else F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    writer = df.select(*columns).write.mode(mode).option("header", True).option("nullValue", "").option("escape", '"')
    # Readers of line breaks take a file in one task. The writer trims by default; blanks around a value are data here.
    writer = writer.option("maxRecordsPerFile", CSV_RECORDS).option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, keys in alphabetical order, everything that is not plain JSON as text."""
    plain = (T.StringType, T.LongType, T.IntegerType, T.BooleanType, T.StructType)
    columns = [
        F.col(f.name) if isinstance(f.dataType, plain) else F.expr(canonical_text(f)).alias(f.name)
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    df.select(*columns).write.mode(mode).option("ignoreNullFields", False).json(path)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT on the session catalog, at ``path`` if one is given."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def published_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that the newest entry of a versioned table points to; None before the first one."""
    if not path_exists(spark, f"{path}/_versions"):
        return None
    return spark.read.schema(VERSIONS).json(f"{path}/_versions").agg(F.max_by("folder", "number")).first()[0]


def point_to(spark: SparkSession, path: str, folder: str, label: str) -> None:
    """Make ``folder`` the current version. The entry is one small file that appears when its write commits."""
    number = 0
    if path_exists(spark, f"{path}/_versions"):
        number = spark.read.schema(VERSIONS).json(f"{path}/_versions").agg(F.max("number")).first()[0] + 1
    entry = spark.createDataFrame([(number, folder, label)], VERSIONS).coalesce(1)
    entry.write.mode("append").json(f"{path}/_versions")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table; readers of an older one keep its files."""
    folder = published_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(folder)


def replace_path(df: DataFrame, path: str) -> None:
    """Truncate and reload a path."""
    df.write.mode("overwrite").parquet(path)
