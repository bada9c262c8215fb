"""Mixing sources to target weights by weighted fair queueing.

Every document is offered up to ``repeats`` times. Within its source documents are shuffled by a hash; the finish time of
a document is the words of its source up to and including it, over the target of the source. All offers are range-sorted
by finish time, and the queue is cut where the words taken reach the total budget.

Only ids, sizes and hashes travel. Running sums are taken in two steps, sums of slots or range partitions first, so a
source with a third of all rows is dealt over many tasks. The tables of sources, and of range partitions, have a row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import WORD
from tidemark.session import materialise

WEIGHTS = (5, 2, 1)
KEY = ["doc_id", "source", "text_md5"]


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """(source, source_size, n_docs) with source_no and target: words shared by weight, capped at repeats * size.

    Sources filled to their cap come first in the order of cap over weight; what they leave is shared by the others.
    The windows run over the table of sources, a row each.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("source_no", F.row_number().over(by_name))
    kinds = F.array([F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.get(kinds, (F.col("source_no") - 1) % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * repeats)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    level = (
        ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("filled", F.sum("cap").over(filling) - F.col("cap"))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.sum("weight").over(filling) + F.col("weight"))
        .withColumn("full", F.col("cap") * F.col("open_weight") <= F.col("weight") * (F.col("budget") - F.col("filled")))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)))
        .withColumn("rest_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("rest") / F.col("rest_weight"))
    return level.select("source", "source_no", "source_size", "n_docs", target.alias("target"))


def plan_mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 0,
    slot_docs: int = 512,
) -> DataFrame:
    """Per document: doc_id, source, text_md5, n_rows, size, source_size, target, copies and taken (copies * size).

    Sources in the order of code points, null last, weigh ``weights`` in turn and share ``share`` of all words; a target
    stops at ``repeats`` times its source, the excess goes to the others by weight. No document is taken more than
    ``repeats`` times. Null text: size 0. Rows equal in id, source and text are one document of ``n_rows`` rows with one
    place in the queue and one verdict. The order depends on seed, id and text only, so reruns agree. A document of size
    0 is never in the way: it is taken where its place comes before the cut; if its source has no word, not at all. An
    empty table gives none.
    """
    n_words = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).alias("source"),
        F.md5(F.coalesce(F.col(text_column), F.lit(""))).alias("text_md5"),
        n_words.alias("size"),
    )
    units = rows.groupBy(*KEY).agg(F.count("*").alias("n_rows"), F.first("size").alias("size"))
    units = materialise(units.withColumn("words", F.col("size") * F.col("n_rows")), "sizes")
    sizes = units.groupBy("source").agg(F.sum("words").alias("source_size"), F.count("*").alias("n_docs"))
    targets = materialise(source_targets(sizes, weights, share, repeats), "targets")
    budget = targets.agg(F.sum("source_size")).first()[0] or 0

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_md5"))
    placed = units.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    placed = placed.withColumn("place", order)
    at = F.conv(F.substring("place", 1, 13), 16, 10).cast("double") / float(1 << 52)
    placed = placed.withColumn("slot", F.floor(at * F.ceil(F.col("n_docs") / slot_docs)))
    slots = placed.groupBy("source_no", "slot").agg(F.sum("words").alias("slot_words"))
    before = F.sum("slot_words").over(Window.partitionBy("source_no").orderBy("slot")) - F.col("slot_words")
    slots = slots.select("source_no", "slot", before.alias("before"))
    inside = Window.partitionBy("source_no", "slot").orderBy("place", "doc_id", "text_md5").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(slots, ["source_no", "slot"]).withColumn("so_far", F.col("before") + F.sum("words").over(inside))

    offers = summed.where("target > 0").select(
        *KEY, "place", "words", "so_far", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")
    )
    finish = (F.col("turn") * F.col("source_size") + F.col("so_far")) / F.col("target")
    queue = offers.select(*KEY, "place", "words", "turn", finish.alias("finish"))
    in_order = ["finish", "place", "turn"]
    queue = materialise(queue.repartitionByRange(*in_order).withColumn("part", F.spark_partition_id()), "queue")

    totals = queue.groupBy("part").agg(F.sum("words").alias("part_words"))
    ahead = F.sum("part_words").over(Window.orderBy("part")) - F.col("part_words")
    limit = F.lit(budget * float(share))
    queue = queue.join(totals.withColumn("ahead", ahead), "part")
    whole = queue.where(F.col("ahead") + F.col("part_words") <= limit)
    edge = queue.where((F.col("ahead") <= limit) & (F.col("ahead") + F.col("part_words") > limit))
    running = F.sum("words").over(Window.partitionBy("part").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("reached", F.col("ahead") + running).where(F.col("reached") <= limit).drop("reached")
    taken = whole.unionByName(edge).groupBy(*[F.col(c).alias(f"of_{c}") for c in KEY]).agg(F.count("*").alias("copies"))

    same = None
    for c in KEY:
        equal = F.col(c).eqNullSafe(F.col(f"of_{c}"))
        same = equal if same is None else same & equal
    copies = F.coalesce("copies", F.lit(0))
    result = units.join(taken, same, "left").join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return result.select(*KEY, "n_rows", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **how) -> DataFrame:
    """The mixed corpus: every document as many times as ``plan_mix`` takes it; its columns are those of ``docs``."""
    plan = plan_mix(docs, id_column, text_column, source_column, **how).where("copies > 0")
    plan = plan.select(*[F.col(c).alias(f"plan_{c}") for c in KEY], F.col("copies").alias("plan_copies"))
    same = (
        F.col("row")[id_column].cast("long").eqNullSafe(F.col("plan_doc_id"))
        & F.col("row")[source_column].eqNullSafe(F.col("plan_source"))
        & (F.col("text_md5") == F.col("plan_text_md5"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.md5(F.coalesce(F.col(text_column), F.lit(""))).alias("text_md5"))
    taken = rows.join(plan, same).select("row", F.explode(F.sequence(F.lit(1), F.col("plan_copies").cast("int"))))
    return taken.select("row.*")
