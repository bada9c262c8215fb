"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked through pigeonhole blocks.

A fingerprint is cut into blocks. If two fingerprints differ in at most d bits, they agree on all but d blocks, so every
choice of blocks to agree on gives a join key; keys bring candidates together and the Hamming distance decides. Only
distinct fingerprints take part; documents with equal ones are one class. A key with many fingerprints (the cloud of a
large group of near copies) is split again: the free bits are cut into d + 1 parts, of which a close pair shares one. As
fingerprints under a key differ in the free bits only, few free bits mean few fingerprints, and the splitting ends with
small groups without leaving out a pair. Within a group the links found form a forest, at most one per member, never all
pairs; a pair left out is connected through others.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import connected, with_hash
from tidemark.llm.rows import with_text_columns
from tidemark.session import materialise

BITS = 64
SEED = 42
#: Stands for a null id: after every other.
LAST = (1 << 63) - 1
#: Shingle hashes whose bits are counted at a time.
PIECE = 1 << 15
FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprint(text: bytes, width: int) -> int:
    """Majority bits of the XXH64 of all shingles, repeats included; as an unsigned number. No word: zero."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, ends = [0, *ends[: max(0, len(words) - width)].tolist()], (ends[width - 1 :] - 1).tolist() or [len(joined)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(ends), PIECE):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + PIECE], ends[at : at + PIECE], strict=False)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_column: str = "text", width: int = 3) -> DataFrame:
    """The documents with ``fingerprint`` (long, the 64 bits as a signed number); a null text has no words: zero."""

    def compute(texts: list[bytes]) -> list[pa.Array]:
        found = np.array([fingerprint(t, width) for t in texts], np.uint64)
        return [pa.array(found.view(np.int64), pa.int64())]

    return with_text_columns(docs, text_column, FINGERPRINT, compute)


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts(mask: int, n: int) -> list[int]:
    """The bits of a mask in n runs of about equal length."""
    bits = [1 << i for i in range(BITS) if mask >> i & 1]
    return [sum(bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def forest(prints: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links within a group that connect whatever its pairs within the distance connect."""
    a, b = [], []
    rest = np.unique(prints).view(np.uint64)
    frontier: list[np.uint64] = []
    while len(rest):
        if not frontier:
            frontier, rest = [rest[0]], rest[1:]
            continue
        x = frontier.pop()
        near = np.bitwise_count(rest ^ x) <= distance
        if near.any():
            found = rest[near]
            frontier.extend(found)
            a += [int(x.astype(np.int64))] * len(found)
            b += found.view(np.int64).tolist()
            rest = rest[~near]
    return a, b


def close_links(distinct: DataFrame, distance: int = 2, blocks: int = 4, group: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in ``distance`` bits or fewer, enough to connect all such.

    ``group`` bounds the fingerprints compared in one place; it must be at least 2**12 / 4, so that splitting ends.
    """
    if distance == 0:
        return distinct.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    cut = parts((1 << BITS) - 1, blocks)
    masks = [sum(chosen) for chosen in combinations(cut, blocks - distance)]
    keyed = distinct.withColumn("mask", F.explode(F.array([F.lit(signed(m)) for m in masks])))
    links = None
    while True:
        keyed = keyed.select("fingerprint", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
        keyed = materialise(keyed, "keyed")
        sizes = keyed.groupBy("mask", "key", F.xxhash64("mask", "key").alias("key_hash")).agg(F.count("*").alias("n"))
        shared = materialise(keyed.join(sizes.where("n > 1").select("mask", "key", "n"), ["mask", "key"]), "shared")
        few = shared.where(F.col("n") <= group)
        groups = few.groupBy("mask", "key").agg(F.collect_list("fingerprint").alias("members")).select("members")
        found = groups.mapInArrow(lambda batches: _forests(batches, distance), "a long, b long")
        links = found if links is None else links.unionByName(found)
        many = shared.where(F.col("n") > group)
        if many.isEmpty():
            return links
        finer = {m: [m | p for p in parts(((1 << BITS) - 1) ^ m, distance + 1)] for m in masks}
        masks = sorted({x for xs in finer.values() for x in xs})
        lookup = F.create_map(*(c for m, xs in finer.items() for c in (F.lit(signed(m)), F.array([F.lit(signed(x)) for x in xs]))))
        keyed = many.select("fingerprint", F.explode(lookup[F.col("mask")]).alias("mask"))


def _forests(batches, distance: int):
    for batch in batches:
        a, b = [], []
        for members in batch.column("members"):
            x, y = forest(members.values.to_numpy(), distance)
            a += x
            b += y
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 3,
    distance: int = 2,
    blocks: int = 4,
) -> DataFrame:
    """Per document: doc_id, text_hash, fingerprint (long), component_id and component.

    ``component_id`` is the smallest doc_id reachable over fingerprints within ``distance`` bits, ``component`` the
    smallest fingerprint reached. Texts are lower-cased in A-Z and cut into words at ASCII white space; shingles are
    ``width`` words. Fewer words: the whole sequence is the only shingle; none or a null text: fingerprint zero, linked
    like any other. Null ids count after all others; a component of null ids only has a null id. Rows that repeat an id
    are answered for one by one. An empty table gives none. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    prints = materialise(fingerprints(rows, "text", width).select("doc_id", "text_hash", "fingerprint"), "prints")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    classes = materialise(classes, "classes")

    nodes = connected(close_links(classes.select("fingerprint"), distance, blocks))
    linked = nodes.join(classes, F.col("node") == F.col("fingerprint"))
    least = linked.groupBy("root", with_hash("root")).agg(F.min("first_id").alias("least_id")).drop("key_hash")
    of_linked = linked.select("root", "node").join(least, "root")
    known = classes.join(of_linked, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint",
        F.when(F.col("node").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"),
        F.coalesce("root", "fingerprint").alias("component"),
    )
    return prints.join(materialise(known, "components"), "fingerprint").select(
        "doc_id", "text_hash", "fingerprint", "component_id", "component"
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id, nulls last, stays.

    Of several rows with that id the text with the smallest hash stays, and of equal rows a single one.
    """
    return one_of_each(docs, near_duplicates(docs, id_column, text_column, **how), id_column, text_column)


def one_of_each(docs: DataFrame, found: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The documents that stay, by the doc_id, text_hash and component found for each."""
    place = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("place")
    chosen = found.select("component", F.coalesce("doc_id", F.lit(LAST)).alias("place"), "text_hash")
    chosen = chosen.groupBy("component").agg(F.min(F.struct("place", "text_hash")).alias("one")).select("one.*")
    rows = docs.select(F.struct(*docs.columns).alias("row"), place, F.xxhash64(text_column).alias("text_hash"))
    nth = F.row_number().over(Window.partitionBy("place", "text_hash").orderBy("place"))  # in the layout of the join
    return rows.join(chosen, ["place", "text_hash"]).withColumn("nth", nth).where("nth = 1").select("row.*")
