"""Token ids in ORC files: integer run-length encoding, row indexes, and Bloom filters on document ids.

Documents are range-partitioned by id and written in ascending order, so stripe and row-group statistics prune by id and
Bloom filters prune what the statistics let through; a reader may take stripes in parallel. A file holds the number of
its partition and, for every document, where it starts in that partition; reading adds the ids of the partitions before,
a table with a row per partition, so writing needs one pass over the texts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.segments import identifying
from tidemark.llm.texts import encoded, portions

STORED = "doc_id long, part int, part_start long, n_tokens long, token_ids array<int>"
#: What makes documents in the files findable: indexes, filters on ids, and stripes that a task reads alone.
LAYOUT = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}
#: Bytes of text that are encoded at a time: the more, the fewer distinct words a byte has.
ENCODED_BYTES = 4 << 20


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    **layout: str,
) -> None:
    """Encode every text, put ``end_id`` behind it, and write the ids to ORC files in ascending order of ids.

    ``tokenizer`` is the path of a file of the tokenizers library, present on every machine; special strings inside texts
    are taken as by default, none are added. Null and empty texts hold the end id alone. Null ids come first; rows with
    equal ids follow by a hash of the text, then by text. Other columns are not written. ``layout`` overrides LAYOUT.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)

    def run(batches):
        memory.begin(tokenizer)
        so_far = 0
        for part in portions(batches, "text", ENCODED_BYTES):
            ids, sizes = identifying(tokenizer).joined(encoded(part.column("text")))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            edges = np.concatenate([[0], np.cumsum(sizes)])
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))
            columns = [part.column("doc_id"), part.column("part"), pa.array(so_far + edges[:-1]), pa.array(sizes), lists]
            so_far += int(edges[-1])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "part_start", "n_tokens", "token_ids"])

    numbered = dealt.withColumn("part", F.spark_partition_id())
    numbered.mapInArrow(run, STORED).write.options(**(LAYOUT | layout)).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens (with the end id) and token_ids of every stored document.

    Filters on doc_id reach the stripes. The sums of partitions are read from two columns; they have a row of two numbers
    for each partition of the writing job, which bounds what is broadcast.
    """
    stored = spark.read.schema(STORED).orc(path)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    ahead = F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")
    parts = parts.select("part", ahead.alias("ahead"))
    start = (F.col("ahead") + F.col("part_start")).alias("start")
    return stored.join(F.broadcast(parts), "part").select("doc_id", start, "n_tokens", "token_ids")


def with_crc32(rows: DataFrame, ids_column: str = "token_ids", out: str = "ids_crc32") -> DataFrame:
    """The rows with the unsigned CRC-32 of their ids as little-endian 32-bit integers in place of the ids."""
    stay = [c for c in rows.columns if c not in (ids_column, out)]

    def run(batches):
        for batch in batches:
            ids = batch.column(ids_column)
            edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in stay), pa.array(sums, pa.int64())], [*stay, out])

    schema = rows.select(*stay, F.lit(0).cast("long").alias(out)).schema
    return rows.mapInArrow(run, schema)
