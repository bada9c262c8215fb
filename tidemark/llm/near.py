"""Near-dedup by word shingles: pairs whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sources: SimHash fingerprints within a few bits (pigeonhole blocks), which reach the closest
pairs, and MinHash bands for the pairs between 3 and 11 or more bits, which no affordable choice of blocks reaches. Two
sets of similarity s share none of ``BANDS`` bands of ``ROWS`` minima with a probability of (1 - s**ROWS)**BANDS: 5e-6 at
0.8, 4e-10 at 0.85. Candidates only say which documents are compared: those they connect form a cluster, and within a
cluster the exact similarity decides over every pair, so documents that merely collide stay apart.

Documents of equal sets are one node. The members of a key are tied to its smallest node, never to each other. Texts of
clusters travel once; a cluster of more than ``slice_bytes`` is cut into slices, and each two slices meet in a task of
their own. Within a task the links found form a forest, at most one per member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import connected, with_hash
from tidemark.llm.rows import with_text_columns
from tidemark.llm.simhash import LAST, close_links, fingerprint, one_of_each
from tidemark.llm.texts import mixed, split_words, window_hashes, word_hashes
from tidemark.session import materialise

#: MinHash: bands and the minima in each.
BANDS, ROWS = 40, 6
#: Shingles that meet all permutations at a time.
PIECE = 1 << 10
_CODES = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTORS, SHIFTS = (_CODES[: BANDS * ROWS] | np.uint64(1))[:, None], _CODES[BANDS * ROWS :][:, None]
MARKS = T.StructType([T.StructField("node", T.LongType()), T.StructField("fingerprint", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Distinct hashes, ascending, of the shingles of each text; of fewer words the whole sequence is one."""
    words = split_words([t.lower() for t in texts])  # of bytes: ASCII letters only
    hashes = word_hashes(words)
    for a, b in zip(words.first, words.first[1:], strict=False):
        own = hashes[a:b]
        if 0 < len(own) < width:
            yield window_hashes(own, len(own))
        else:
            yield np.unique(window_hashes(own, width))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One number for every band; none for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), PIECE):
        np.minimum(least, (shingles[at : at + PIECE] * FACTORS + SHIFTS).min(axis=1), out=least)
    return mixed((mixed(least) * FACTORS[:, 0]).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64))


def marks(docs: DataFrame, text_column: str, width: int) -> DataFrame:
    """The documents with ``node`` (digest of the set), ``fingerprint`` and ``keys`` (of bands, and of the fingerprint)."""

    def compute(texts: list[bytes]) -> list[pa.Array]:
        nodes, keys = [], []
        prints = np.array([fingerprint(t, width) for t in texts], np.uint64)
        for own, print_key in zip(shingle_sets(texts, width), mixed(prints + np.uint64(1)), strict=True):
            nodes.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "big", signed=True))
            keys.append(np.append(band_keys(own), print_key).view(np.int64))
        return [pa.array(nodes, pa.int64()), pa.array(prints.view(np.int64), pa.int64()), pa.array(keys, pa.list_(pa.int64()))]

    return with_text_columns(docs, text_column, MARKS, compute)


def candidates(marked: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Links (a, b) that connect all nodes with a common key, or with fingerprints within ``distance`` bits."""
    keyed = materialise(marked.select("node", F.explode("keys").alias("key")).distinct(), "node-keys")
    least = keyed.groupBy("key", with_hash("key")).agg(F.min("node").alias("least"), F.max("node").alias("most"))
    by_key = keyed.join(least.where("most > least").select("key", "least"), "key").where("node > least")
    of_print = materialise(marked.groupBy("fingerprint").agg(F.min("node").alias("node")), "print-nodes")
    close = close_links(of_print.select("fingerprint"), distance, blocks)
    ends = [of_print.select(F.col("fingerprint").alias(x), F.col("node").alias(f"{x}_node")) for x in "ab"]
    by_print = close.join(ends[0], "a").join(ends[1], "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    return by_key.select(F.col("node").alias("a"), F.col("least").alias("b")).unionByName(by_print)


def alike(table: pa.Table, width: int, percent: int) -> pa.Table:
    """Links within a group of (node, text) that connect whatever its pairs of ``percent`` similarity or more connect."""
    nodes, links = table.column("node").to_numpy(), []
    sets = list(shingle_sets([x or b"" for x in table.column("text").cast(pa.binary()).to_pylist()], width))
    sizes = np.array([len(s) for s in sets], np.int64)
    edges = np.r_[0, np.cumsum(sizes)]
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked, rest, others, frontier = np.zeros(len(distinct), bool), np.arange(len(sets)), flat, []
    while len(rest):
        if not frontier:
            frontier, rest, others = [rest[0]], rest[1:], others[sizes[rest[0]] :]
            continue
        x = frontier.pop()
        own = flat[edges[x] : edges[x + 1]]
        marked[own] = True
        common = np.diff(np.r_[0, np.cumsum(marked[others])][np.r_[0, np.cumsum(sizes[rest])]])
        marked[own] = False
        near = 100 * common >= percent * (sizes[x] + sizes[rest] - common)
        if near.any():
            links += [(x, y) for y in rest[near].tolist()]
            frontier += rest[near].tolist()
            rest, others = rest[~near], others[np.repeat(~near, sizes[rest])]
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    return pa.Table.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], schema=LINKS)


def alike_links(members: DataFrame, width: int, percent: int, slice_bytes: int) -> DataFrame:
    """Links (a, b) within the clusters of (cluster, node, text)."""
    size = F.sum(F.octet_length("text") + 1)
    slices = members.groupBy("cluster", with_hash("cluster")).agg(F.ceil(size / slice_bytes).cast("int").alias("slices"))
    cut = members.join(slices.select("cluster", "slices"), "cluster")
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).where("slices = 1 OR own <> other")
    cut = cut.select("cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "text")
    return cut.groupBy("cluster", "low", "high").applyInArrow(lambda t: alike(t, width, percent), "a long, b long")


def shingle_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    distance: int = 3,
    blocks: int = 5,
    slice_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document: doc_id, text_hash and component, which documents share that pairs of ``percent`` or more connect.

    Texts are lower-cased in A-Z and cut into words at ASCII white space. Texts without a word and null texts are equal
    to each other and to nothing else. An empty table gives none.
    """
    key = [F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("place"), F.xxhash64(text_column).alias("text_hash")]
    rows = docs.select(*key, F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    marked = materialise(marks(rows, "text", width).drop("text"), "marks")
    clusters = connected(candidates(marked, distance, blocks))

    one = marked.groupBy("node").agg(F.min(F.struct("place", "text_hash")).alias("one")).select("node", "one.*")
    wanted = clusters.join(one, "node").select("node", F.col("root").alias("cluster"), "place", "text_hash")
    nth = F.row_number().over(Window.partitionBy("place", "text_hash").orderBy("place"))  # in the layout of the join
    members = rows.select("place", "text_hash", "text").join(wanted, ["place", "text_hash"]).withColumn("nth", nth)
    members = materialise(members.where("nth = 1").select("cluster", "node", "text"), "members")

    roots = connected(alike_links(members, width, percent, slice_bytes))
    found = marked.select("doc_id", "text_hash", "node").join(roots, "node", "left")
    return found.select("doc_id", "text_hash", F.coalesce("root", "node").alias("component"))


def keep_one_alike(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The documents without near-duplicates by shingles; which one stays is as in ``simhash.keep_one_of_each``."""
    return one_of_each(docs, shingle_components(docs, id_column, text_column, **how), id_column, text_column)
