"""Line dedup over overlapping windows: lines inside a later occurrence of a repeated three-line window are removed.

Lines of a document that hold a word are numbered; every three consecutive ones are hashed to 128 bits. The smallest
place (doc_id, row, line number) of each hash is its first occurrence, all other windows of that hash cover lines to
remove. Rows are numbered in a table that is written first, so rows of one id and text stay apart in every retry.
Only hashes and places are shuffled for that; a hash in a third of all documents meets its first place in a join whose
hot key adaptive execution can split, after a grouping that combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import with_hash
from tidemark.session import materialise

LAST = (1 << 63) - 1  # stands for a null id: after every other
HAS_WORD = r"[^\x20\x09-\x0D]"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, not once per element of an array function in it."""
    return F.transform(F.array(value), use)[0]


def windows_of(text: Column, width: int) -> Column:
    """Windows of a text: (at, lines, hash), the number of the first line, where its lines lie, and their hash."""

    def build(lines: Column) -> Column:
        def one(k: Column) -> Column:
            taken = F.slice(lines, k + 1, F.lit(width))
            digest = F.unhex(F.md5(F.array_join(F.transform(taken, lambda x: x["line"]), "\n")))
            return F.struct(k.alias("at"), F.transform(taken, lambda x: x["place"]).alias("lines"), digest.alias("hash"))

        enough = F.size(lines) >= width
        return F.when(enough, F.transform(F.sequence(F.lit(0), F.greatest(F.size(lines) - width, F.lit(0))), one))

    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("place"), x.alias("line")))
    return bound(F.filter(numbered, lambda s: s["line"].rlike(HAS_WORD)), build)


def without(text: Column, removed: Column) -> Column:
    """The text without the lines at the given places."""

    def build(both: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(both["lines"]) - 1), both["removed"])
        return F.array_join(F.transform(left, lambda i: F.get(both["lines"], i)), "\n")

    return bound(F.struct(F.split(text, "\n", -1).alias("lines"), removed.alias("removed")), build)


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, prefix: str = "dedup_"
) -> DataFrame:
    """The documents, with ``{prefix}text`` (kept lines), ``{prefix}lines`` (lines with a word) and ``{prefix}removed``
    (places of removed lines in the text, counted from 0 over all its lines, ascending).

    Windows are judged on the input; a line in any later occurrence goes, also one that a first occurrence shares. Lines
    without a word take no part and stay. Fewer than ``width`` lines: untouched. Null text: null kept text, no lines. Null
    ids come after all others. Rows that share an id, or have none, follow each other by the hash of their texts; of equal
    texts one row is the first. An empty table gives none. A column named like a result is replaced.
    """
    names = [f"{prefix}{x}" for x in ("text", "lines", "removed")]
    place = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("place")
    stay = [c for c in docs.columns if c not in names]
    number = F.monotonically_increasing_id().alias("number")
    rows = docs.select(F.struct(*stay).alias("row"), place, F.xxhash64(text_column).alias("text_hash"), number)
    rows = materialise(rows, "numbered")
    where = F.struct("place", "text_hash", "number", "at")
    found = rows.select("place", "text_hash", "number", F.explode(windows_of(F.col("row")[text_column], width)).alias("w"))
    found = found.select("place", "text_hash", "number", "w.at", "w.lines", "w.hash")
    first = (
        found.groupBy("hash", with_hash("hash"))
        .agg(F.min(where).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("hash", "first")
    )
    later = found.join(first, "hash").where(where > F.col("first"))
    covered = later.groupBy("number").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines")))).alias("gone"))

    joined = rows.select("row", "number").join(covered, "number", "left")
    text = F.col("row")[text_column]
    lines = F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD)))
    return joined.select(
        *(F.col("row")[c].alias(c) for c in stay),
        F.when(F.col("gone").isNull(), text).otherwise(without(text, F.col("gone"))).alias(names[0]),
        F.when(text.isNull(), 0).otherwise(lines).cast("long").alias(names[1]),
        F.coalesce("gone", F.array().cast("array<int>")).alias(names[2]),
    )
