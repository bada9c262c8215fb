"""Completeness record by record: where every key is present between the layers, and where two tables differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.verdict import union_all
from tidemark.session import materialise

#: Layers in the order of the mask's bits. A record leaves several rows in quarantine, one per failed rule.
PRESENCE_LAYERS = ("source", "raw", "quarantine", "staging", "core")


def _bit(layer: str) -> int:
    return 1 << PRESENCE_LAYERS.index(layer)


def presence(layers: Mapping[str, DataFrame], key: str = "source_record_key", by: Sequence[str] = ()) -> DataFrame:
    """Per record key (and ``by``, such as the batch): ``mask``, a bit per layer that holds it, and rows per layer.

    The layers are folded in one aggregation of narrow rows, combined on the map side, instead of outer joins; a key that
    has very many rows travels as one row per task. A NULL key is a key.
    """
    tagged = [df.select(*by, key, F.lit(_bit(name)).alias("layer")) for name, df in layers.items()]
    rows = [F.count_if(F.col("layer") == _bit(n)).alias(f"{n}_rows") for n in PRESENCE_LAYERS]
    return union_all(tagged).groupBy(*by, key).agg(F.bit_or("layer").alias("mask"), *rows)


def findings() -> Column:
    """What a mask and its counts tell, in the order in which layers are passed; none for a record that is complete."""

    def has(layer: str) -> Column:
        return F.col("mask").bitwiseAND(F.lit(_bit(layer))) != 0

    judged = has("staging") | has("quarantine")
    named = {
        "LOST_BEFORE_RAW": has("source") & ~has("raw"),
        "NOT_IN_SOURCE": has("raw") & ~has("source"),
        "UNACCOUNTED": has("raw") & ~judged,
        "NOT_FROM_RAW": judged & ~has("raw"),
        "VALID_AND_REJECTED": has("staging") & has("quarantine"),
        "LOST_BEFORE_CORE": has("staging") & ~has("core"),
        "NOT_FROM_STAGING": has("core") & ~has("staging"),
        **{f"DOUBLED_IN_{n.upper()}": F.col(f"{n}_rows") > 1 for n in PRESENCE_LAYERS if n != "quarantine"},
    }
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in named.items()]))


def incomplete_records(layers: Mapping[str, DataFrame], key: str = "source_record_key", by: Sequence[str] = ()) -> DataFrame:
    """One row per finding: the key (and ``by``), its mask, and what is wrong with it. Complete records give none."""
    found = presence(layers, key, by).select(*by, key, "mask", F.explode(findings()).alias("finding"))
    return found


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of the values that tells NULLs apart by their place."""
    return F.xxhash64(F.lit(seed), *[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in columns])


def range_digests(df: DataFrame, key: Sequence[str], columns: Sequence[str], groups: int = 64, leaves: int = 64) -> DataFrame:
    """(branch, leaf, n, total, mix): digests of the multiset of rows in ranges of the key's hash.

    Digests do not depend on order and add up, so they can be stored beside a manifest, and those of a branch follow from
    its leaves. Their number is bounded by ``groups * leaves``, whatever the table's size.
    """
    h = F.xxhash64(*key)
    branch = F.pmod(h, F.lit(groups)).cast("int")
    leaf = F.pmod(F.floor(h / groups), F.lit(leaves)).cast("int")
    whole = [*key, *(c for c in columns if c not in key)]  # rows that two keys exchange are a change
    values = df.select(branch.alias("branch"), leaf.alias("leaf"), row_hash(whole, 1).alias("a"), row_hash(whole, 2).alias("b"))
    return values.groupBy("branch", "leaf").agg(
        F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("total"), F.bit_xor("b").alias("mix")
    )


def unequal_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """(branch, leaf) of the ranges whose digests differ: branches first, then the leaves of those that do."""

    def differing(a: DataFrame, b: DataFrame, ranges: list[str]) -> DataFrame:
        def side(df: DataFrame, sign: int) -> DataFrame:
            total = F.sum("total").cast("decimal(38,0)")
            return df.groupBy(*ranges).agg(F.sum("n").alias("n"), total.alias("total"), F.bit_xor("mix").alias("mix")).withColumn("side", F.lit(sign))

        folded = side(a, 1).unionByName(side(b, -1)).groupBy(*ranges, "n", "total", "mix").agg(F.sum("side").alias("side"))
        return folded.where("side <> 0").select(*ranges).distinct()

    branches = differing(left, right, ["branch"])
    open_left, open_right = (d.join(branches, "branch", "left_semi") for d in (left, right))
    return differing(open_left, open_right, ["branch", "leaf"])


def differences(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str], groups: int = 64, leaves: int = 64) -> DataFrame:
    """Keys whose rows differ between two tables: ONLY_LEFT, ONLY_RIGHT or CHANGED.

    Both tables are read for their digests, but only rows in unequal ranges are shuffled and compared one by one; the
    ranges are settled first, so Spark knows how few they are. Rows are multisets: a row that one side has twice is a
    change. ``columns`` are what is compared; missing keys count as a value.
    """
    ranges = unequal_ranges(*(materialise(range_digests(df, key, columns, groups, leaves), "digests") for df in (left, right)))
    ranges = materialise(ranges, "unequal-ranges")
    h = F.xxhash64(*key)

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(
            *key, F.pmod(h, F.lit(groups)).cast("int").alias("branch"), F.pmod(F.floor(h / groups), F.lit(leaves)).cast("int").alias("leaf"),
            row_hash(columns, 1).alias("a"), row_hash(columns, 2).alias("b"),
        )
        return rows.join(ranges, ["branch", "leaf"], "left_semi").select(*key, "a", "b", F.lit(sign).alias("side"))

    per_row = side(left, 1).unionByName(side(right, -1)).groupBy(*key, "a", "b").agg(F.sum("side").alias("n"), F.sum(F.abs("side")).alias("seen"))
    per_key = per_row.groupBy(*key).agg(
        F.sum((F.col("seen") + F.col("n")) / 2).alias("in_left"), F.sum((F.col("seen") - F.col("n")) / 2).alias("in_right"),
        F.bool_or(F.col("n") != 0).alias("differs"),
    )
    kind = F.when(F.col("in_right") == 0, "ONLY_LEFT").when(F.col("in_left") == 0, "ONLY_RIGHT").otherwise("CHANGED")
    return per_key.where("differs").select(*key, kind.alias("difference"))
