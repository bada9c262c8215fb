"""Substring dedup: word windows that already stand in a document with a smaller id are cut out.

Rabin-Karp hashes of every window of ``width`` words are counted globally, and overlapping repeated windows merge into
maximal removal intervals.

How it runs. Documents are dealt into chunks of bounded size by a hash of id and text. A chunk computes its window
hashes, keeps each distinct hash once with the smallest doc_id that has it, sorts them, and sends each hash range
(bucket) one packed row. The task of a bucket finds for every hash the smallest doc_id of all chunks and answers each
chunk with one bit per hash sent: "also starts in a document smaller than any of yours". The chunk recomputes the same
sorted hashes and reads the bits. So a window crosses the network once per chunk that has it, packed; a passage in a
third of all documents costs a bucket one entry per chunk; answers are bits. Both branches share one exchange of texts.

Memory. A chunk has about ``chunk_bytes`` of text (or one longer document), a bucket about ``bucket_windows`` windows.

Hashes have 64 bits. Two different windows share one with a probability of 2**-64 per pair, up to a few bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import encoded, split_words, window_hashes, word_hashes

#: Null ids come after every other.
LAST = np.iinfo(np.int64).max

BLOCKS = "bucket int, chunk long, n long, hashes binary, docs binary, base long"
ANSWERS = "chunk long, bucket int, n long, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,stop:long>>"


def planes(numbers: np.ndarray) -> bytes:
    """Byte planes of an array: equal high bytes of sorted or small numbers lie together, which shuffle compression uses."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class Chunk:
    """Windows of the documents of one chunk. Rows are taken in the order of doc_id, nulls last."""

    def __init__(self, table: pa.Table, width: int):
        ids = table.column("doc_id").to_pylist()
        ids = np.array([LAST if x is None else x for x in ids], np.int64)
        self.order = np.argsort(ids, kind="stable")
        texts = encoded(table.column("text"))
        self.ids, self.words = ids[self.order], split_words([texts[i] for i in self.order])
        first, hashes = self.words.first, word_hashes(self.words)
        self.count = np.diff(first)
        begins = np.ones(len(hashes), bool)  # of a window that ends in its document
        for stop in first[1:]:
            begins[max(0, stop - width + 1) : stop] = False
        self.at = np.flatnonzero(begins)  # documents shorter than a window: all their words are within its reach
        every = window_hashes(hashes, width)
        self.owner = np.repeat(np.arange(len(self.ids)), self.count)[self.at]
        self.distinct, where, self.inverse = np.unique(every[self.at], return_index=True, return_inverse=True)
        self.smallest = self.ids[self.owner[where]]  # windows are in the order of doc_id, and `where` is the first


def sent(table: pa.Table, width: int, bits: int):
    """A packed row of distinct hashes for every bucket."""
    chunk = Chunk(table, width)
    if not len(chunk.distinct):
        return
    base = int(chunk.smallest.min())
    offsets = (chunk.smallest - base).view(np.uint64)
    edges = np.searchsorted(chunk.distinct >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    rows = [(b, s, e) for b, (s, e) in enumerate(zip(edges, edges[1:], strict=False)) if e > s]
    yield pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
            "chunk": pa.array([table.column("chunk")[0].as_py()] * len(rows), pa.int64()),
            "n": pa.array([e - s for _, s, e in rows], pa.int64()),
            "hashes": pa.array([planes(chunk.distinct[s:e]) for _, s, e in rows], pa.binary()),
            "docs": pa.array([planes(offsets[s:e]) for _, s, e in rows], pa.binary()),
            "base": pa.array([base] * len(rows), pa.int64()),
        }
    )


def answered(table: pa.Table):
    """One bit for every hash of every row: a smaller doc_id than the sender's smallest has it."""
    sizes = table.column("n").to_numpy()
    hashes = np.concatenate([unplaned(x) for x in table.column("hashes").to_pylist()])
    docs = np.concatenate([unplaned(x).view(np.int64) + base for x, base in zip(table.column("docs").to_pylist(), table.column("base").to_pylist(), strict=True)])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    least = np.repeat(np.minimum.reduceat(docs[order], starts), np.diff(np.r_[starts, len(hashes)]))
    smaller = np.empty(len(hashes), bool)
    smaller[order] = least < docs[order]
    edges = np.r_[0, np.cumsum(sizes)]
    bits = [np.packbits(smaller[s:e]).tobytes() for s, e in zip(edges, edges[1:], strict=False)]
    yield pa.RecordBatch.from_pydict(
        {"chunk": table.column("chunk").combine_chunks(), "bucket": table.column("bucket").combine_chunks(), "n": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())}
    )


def spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of True."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cut(table: pa.Table, answers: pa.Table, width: int):
    """Texts without the removed words, and the intervals removed."""
    if not table.num_rows:
        return
    chunk = Chunk(table, width)
    replies = sorted(zip(answers.column("bucket").to_pylist(), answers.column("n").to_pylist(), answers.column("bits").to_pylist(), strict=True))
    elsewhere = np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for _, n, bits in replies)])
    repeated = elsewhere[chunk.inverse] | (chunk.ids[chunk.owner] > chunk.smallest[chunk.inverse])
    n_words = len(chunk.words.starts)
    depth = np.zeros(n_words + 1, np.int64)
    np.add.at(depth, chunk.at[repeated], 1)
    np.add.at(depth, chunk.at[repeated] + width, -1)
    removed = np.cumsum(depth[:-1]) > 0

    data, first = chunk.words.data.copy(), chunk.words.first
    data[chunk.words.ends] = 32  # a word takes one space along
    step = np.zeros(len(data) + 1, np.int8)
    step[chunk.words.starts[~removed]] += 1
    step[chunk.words.ends[~removed] + 1] -= 1
    keep = np.cumsum(step[:-1], dtype=np.int8) > 0
    sizes = np.add.reduceat(np.r_[np.where(removed, 0, chunk.words.ends - chunk.words.starts + 1), 0], first[:-1]) if n_words else np.zeros(len(chunk.ids), np.int64)
    sizes[chunk.count == 0] = 0
    kept, ends = data[keep].tobytes(), np.cumsum(sizes)
    texts = [kept[e - s : max(e - 1, e - s)].decode() for s, e in zip(sizes, ends, strict=True)]

    outer = []
    for a, b in zip(first, first[1:], strict=False):
        starts, stops = spans(removed[a:b])
        outer.append([{"start": s, "stop": e} for s, e in zip(starts.tolist(), stops.tolist(), strict=True)])
    gone = np.r_[0, np.cumsum(removed)]
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.ids == LAST),
            "n_words": pa.array(chunk.count, pa.int64()),
            "n_removed": pa.array(gone[first[1:]] - gone[first[:-1]], pa.int64()),
            "kept_text": pa.array(texts, pa.string()),
            "removed": pa.array(outer, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        }
    )


def dedup_substrings(
    docs: DataFrame,
    width: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = 6 << 20,
    bucket_windows: int = 1_000_000,
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space), removed (word intervals).

    A word goes if a window that covers it also starts in a document with a smaller doc_id; windows are judged on the
    input. Null text: no words. Null id: later than every other id, and no null id is smaller than another, so such
    documents never remove from each other. Rows that repeat a doc_id are each answered for and do not remove from each
    other. Texts shorter than a window and empty tables pass. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    bits = max(1, math.ceil(math.log2(max(2, total / 6 / bucket_windows))))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    blocks = chunked.groupBy("chunk").applyInArrow(lambda t: _one(sent(t, width, bits), BLOCK_SCHEMA), BLOCKS)
    answers = blocks.groupBy("bucket").applyInArrow(lambda t: _one(answered(t), ANSWER_SCHEMA), ANSWERS)
    both = chunked.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(lambda t, a: _one(cut(t, a, width), RESULT_SCHEMA), RESULT)


BLOCK_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("base", pa.int64())])
ANSWER_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.binary())])
RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def _one(batches, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([b.cast(schema) for b in batches], schema)
