"""Immutable batch landing with per-file checksums and a manifest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.verdict import row_count
from tidemark.schemas import SCHEMA_VERSION, SOURCE_SYSTEM, Entity
from tidemark.sources.readers import EmptyExtract, extract, path_exists, read_parquet, remove_path
from tidemark.sources.sinks import JSON_INSTANTS

# Bytes of a file that a hashing task holds at a time.
HASH_STEP = 4 << 20


def batch_path(root: str, entity: Entity, batch_id: str) -> str:
    return f"{root}/{entity.name}/{batch_id}"


def manifest_path(root: str, entity: Entity, batch_id: str) -> str:
    return f"{root}/_manifest/{entity.name}/{batch_id}"


def _range_columns(entity: Entity) -> list[tuple[str, str]]:
    """(column, manifest suffix): a single key is ``source_key``, composite parts keep their names."""
    keys = [(entity.key[0], "source_key")] if len(entity.key) == 1 else [(k, k) for k in entity.key]
    return [*keys, ("updated_at", "updated_at")]


def range_aggregates(entity: Entity) -> list[Column]:
    """Row count and the min/max of the key columns and of ``updated_at``, compared in their own types and then made text.

    Spark makes the text, in the zone of the session; the driver's zone plays no part, and a range of NULLs stays NULL.
    """
    aggregates = [row_count().alias("row_count")]
    for column, suffix in _range_columns(entity):
        aggregates += [f(column).cast("string").alias(f"{side}_{suffix}") for side, f in (("min", F.min), ("max", F.max))]
    return aggregates


Opener = Callable[[str], tuple[fs.FileSystem, str]]


def file_checksums(spark: SparkSession, path: str, opener: Opener | None = None) -> DataFrame:
    """(file_name, sha256, file_bytes) of every part file below ``path``, sub-folders included.

    Only names and lengths are listed by Spark; files are dealt over as many tasks as there are files. ``opener`` turns the
    URI of a file into a pyarrow file system and a path there; a file is then hashed in steps of bounded size, so it may be
    of any length. Local paths have one. Without an opener files are read by Spark, that is through the Hadoop file system
    and the credentials of the session, whatever the scheme; a file may then have up to 2 GB. ``file_name`` is relative to
    ``path``.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    files = reader.load(path)
    name = _below(path, F.col("path")).alias("file_name")
    if opener is None and not is_local(spark, path):
        return files.select(name, F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_bytes"))
    files, opened = files.select("path", "length"), opener or fs.FileSystem.from_uri
    count = files.count()

    def hashed(batches):
        for batch in batches:
            sums = [_sha256_of(*opened(p)) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(sums, pa.string()), batch.column("length")], ["path", "sha256", "file_bytes"]
            )

    dealt = files.repartition(max(1, count), "path")
    return dealt.mapInArrow(hashed, "path string, sha256 string, file_bytes long").select(name, "sha256", "file_bytes")


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path, with the session's default file system, belongs to the local one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def _sha256_of(files: fs.FileSystem, path: str) -> str:
    total = hashlib.sha256()
    with files.open_input_stream(path) as stream:
        while step := stream.read(HASH_STEP):
            total.update(step)
    return total.hexdigest()


def _below(folder: str, path: Column) -> Column:
    """The part of a file's URI behind its folder; the folder alone if it is the file itself."""
    bare = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", folder).strip("/")
    name = F.substring_index(path, f"/{bare}/", -1)
    return F.when(F.contains(path, F.lit(f"/{bare}/")), name).otherwise(F.element_at(F.split(path, "/"), -1))


def file_rows(landed: DataFrame, path: str) -> DataFrame:
    """Rows per part file below ``path``; no column is read, and names are made per file, not per row."""
    files = landed.groupBy(F.col("_metadata.file_path").alias("file")).agg(row_count().alias("file_row_count"))
    return files.select(_below(path, F.col("file")).alias("file_name"), "file_row_count")


def manifest_schema(entity: Entity) -> T.StructType:
    ranges = [f"{side}_{suffix}" for _, suffix in _range_columns(entity) for side in ("min", "max")]
    text, whole, instant = T.StringType(), T.LongType(), T.TimestampType()
    return T.StructType(
        [T.StructField(n, text) for n in ("batch_id", "source_system", "source_table", "file_name", "file_format")]
        + [T.StructField("row_count", whole)]
        + [T.StructField(n, text) for n in ranges]
        + [T.StructField("extracted_at", instant), T.StructField("sha256", text), T.StructField("file_bytes", whole)]
        + [T.StructField("file_row_count", whole), T.StructField("schema_version", text)]
    )


def read_manifest(spark: SparkSession, entity: Entity, root: str, batch_id: str) -> DataFrame:
    return spark.read.schema(manifest_schema(entity)).options(**JSON_INSTANTS).json(manifest_path(root, entity, batch_id))


def is_landed(spark: SparkSession, entity: Entity, root: str, batch_id: str) -> bool:
    """A batch counts as landed once its manifest is written, which happens last."""
    return path_exists(spark, manifest_path(root, entity, batch_id) + "/_SUCCESS")


def land(
    df: DataFrame,
    entity: Entity,
    root: str,
    batch_id: str,
    extracted_at: Column,
    source_system: str = SOURCE_SYSTEM,
    finish: bool = False,
) -> DataFrame:
    """Write one batch and its manifest; return the manifest, one row per part file.

    Fails if the batch was landed before. Row count and ranges are observed by the writing tasks themselves, so the
    extract is computed once and a retried task counts once; if there was no row, nothing stays and the extract fails.
    ``finish`` continues an interrupted run: a batch with a manifest is complete and kept, one without is rewritten.
    """
    spark = df.sparkSession
    if finish and is_landed(spark, entity, root, batch_id):
        return read_manifest(spark, entity, root, batch_id)
    rows = extract(df, entity)
    seen = Observation(f"{entity.name}-{batch_id}")
    target = batch_path(root, entity, batch_id)
    rows.observe(seen, *range_aggregates(entity)).write.mode("overwrite" if finish else "errorifexists").parquet(target)

    observed = seen.get
    if not observed["row_count"]:
        remove_path(spark, target)
        raise EmptyExtract(f"no rows extracted from {entity.source_table}")
    counted = file_rows(read_parquet(spark, entity, target), target)
    manifest = file_checksums(spark, target).join(counted, "file_name", "left").select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source_system).alias("source_system"),
        F.lit(entity.source_table).alias("source_table"),
        "file_name",
        F.lit("parquet").alias("file_format"),
        *[F.lit(v).cast("bigint" if n == "row_count" else "string").alias(n) for n, v in observed.items()],
        extracted_at.cast("timestamp").alias("extracted_at"),
        "sha256",
        "file_bytes",
        F.coalesce("file_row_count", F.lit(0)).cast("bigint").alias("file_row_count"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    stored = manifest_path(root, entity, batch_id)
    manifest.write.mode("overwrite" if finish else "errorifexists").options(**JSON_INSTANTS).json(stored)
    return read_manifest(spark, entity, root, batch_id)


def read_batch(spark: SparkSession, entity: Entity, root: str, batch_id: str) -> DataFrame:
    return read_parquet(spark, entity, batch_path(root, entity, batch_id))


def verify_landing(spark: SparkSession, entity: Entity, root: str, batch_id: str) -> DataFrame:
    """One row: manifest against files. Mismatches cover changed, missing and unlisted files."""
    manifest = read_manifest(spark, entity, root, batch_id)
    path = batch_path(root, entity, batch_id)
    listed = manifest.select("file_name", F.col("sha256").alias("listed"), F.lit(None).cast("string").alias("found"))
    actual = file_checksums(spark, path).select(
        "file_name", F.lit(None).cast("string").alias("listed"), F.col("sha256").alias("found")
    )
    per_file = listed.unionByName(actual).groupBy("file_name").agg(
        F.max("listed").alias("listed"), F.max("found").alias("found")
    )
    mismatched = per_file.agg(
        F.count(F.when(~F.col("listed").eqNullSafe(F.col("found")), 1)).alias("file_mismatches")
    )
    promised = manifest.agg(F.max("row_count").alias("manifest_rows"))
    landed = read_parquet(spark, entity, path).agg(row_count().alias("landed_rows"))

    def labelled(one_row: DataFrame, name: str) -> DataFrame:
        return one_row.select(F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("value"))

    facts = (
        labelled(mismatched, "file_mismatches")
        .unionByName(labelled(promised, "manifest_rows"))
        .unionByName(labelled(landed, "landed_rows"))
    )
    names = ("manifest_rows", "landed_rows", "file_mismatches")
    return facts.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]).select(
        F.lit(entity.source_table).alias("source_table"),
        "*",
        F.when((F.col("manifest_rows") == F.col("landed_rows")) & (F.col("file_mismatches") == 0), "PASS")
        .otherwise("FAIL")
        .alias("status"),
    )


def landed_files(spark: SparkSession, entities: Mapping[str, Entity], root: str, batch_id: str) -> DataFrame:
    """Every file of a landed batch over all its tables: table, file name, rows, bytes and SHA-256."""
    names = ["source_table", "file_name", "file_row_count", "file_bytes", "sha256"]
    parts = [read_manifest(spark, e, root, batch_id).select(*names) for e in entities.values()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def dataset_manifest(tables: Mapping[str, DataFrame], entities: Mapping[str, Entity]) -> DataFrame:
    """Row count and key/time ranges of several tables in one result; keys are compared in their own types."""
    parts = []
    for name, df in tables.items():
        entity = entities[name]
        key = F.struct(*entity.key)

        def end(side: str, entity: Entity = entity) -> Column:
            return F.expr(
                "concat_ws('|', " + ", ".join(f"CAST({side}_key.{c} AS STRING)" for c in entity.key) + ")"
            ).alias(f"{side}_key_text")

        parts.append(
            df.agg(
                row_count().alias("row_count"),
                F.min(key).alias("min_key"),
                F.max(key).alias("max_key"),
                F.min("updated_at").alias("min_updated_at"),
                F.max("updated_at").alias("max_updated_at"),
            ).select(
                F.lit(entity.source_table).alias("source_table"), "row_count", end("min"), end("max"), "min_updated_at", "max_updated_at"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
