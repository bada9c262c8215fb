"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found over pairs of trie nodes.

How it runs. The words are sorted, and the nodes of their trie are numbered along that order: a word shares with the one
before it the nodes of their common prefix, and the rest are new. The reversed words number the nodes of a second trie, of
suffixes. So a pair (prefix node, suffix node) is a pair of integers that stands for what lies before and behind some place
of a word, exactly, without hashes. Every word gives the pairs around each place between two code points (split) and the
pairs that leave out one code point (skipped). Then

* two words with a skipped pair in common differ by the code point replaced there, and have just one such pair;
* a word whose skipped pair is another word's split is that word with a code point inserted. Skipping any of several equal
  neighbours gives the same, so only the first of them counts.

A pair holds at most as many words as there are code points, and pairs are ranked within, never listed against each other:
every word takes from a pair how many others are there and the best of them. All work is linear in the words' lengths.

Numbers across partitions. Range partitions number on their own. A partition's first word tells which of its first nodes
lie on the path of the last word before it; those are renamed. For that the driver sees the first and last word of each
partition, and the numbers along the last.
"""

from __future__ import annotations

import math
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.session import materialise

#: A node is the number of its partition, shifted by so many bits, and its own number there.
PART_BITS = 40
#: A form occurs so many times as often as its variants, at least.
FORM_TIMES = 5
LOCAL = "key long, sorted string, part long, edge int, nodes array<long>, fresh array<boolean>"
FIRST, LAST_ROW = 1, 2


def local_nodes(batches):
    """Nodes of the trie of the texts in a partition, which ascend: along the first they count from 0."""
    memory.begin()
    part = TaskContext.get().partitionId()
    before, path, known = "", [0], 0
    held = None  # the last row so far, which is told apart once no other follows
    for batch in batches:
        out = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("sorted").to_pylist(), strict=True):
            n = len(commonprefix((before, text)))
            path = path[: n + 1] + list(range(known + 1, known + 1 + len(text) - n))
            known += len(text) - n
            before = text
            if held is not None:
                out.append(held)
            held = [key, text, part, 0 if held else FIRST, path, [i == 0 or text[i] != text[i - 1] for i in range(len(text))]]
        if out:
            yield _rows(out)
    if held is not None:
        held[3] |= LAST_ROW
        yield _rows([held])


def _rows(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_())]
    names = ["key", "sorted", "part", "edge", "nodes", "fresh"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def renamed(edges: list) -> dict[int, np.ndarray]:
    """Per partition, the numbers that stand for its first nodes: those on the path of the last word before it."""
    firsts = {e.part: e.sorted for e in edges if e.edge & FIRST}
    lasts = {e.part: e for e in edges if e.edge & LAST_ROW}
    names: dict[int, np.ndarray] = {}
    before, path = "", np.zeros(1, np.int64)  # the root has one number everywhere
    for part in sorted(firsts):
        n = len(commonprefix((before, firsts[part])))
        names[part] = path[: n + 1]
        own = np.array(lasts[part].nodes, np.int64)
        before, path = lasts[part].sorted, global_nodes(own, part, names[part])
    return names


def global_nodes(nodes: np.ndarray, part: int, names: np.ndarray) -> np.ndarray:
    return np.where(nodes < len(names), names[np.minimum(nodes, len(names) - 1)], (part << PART_BITS) + nodes)


def trie_nodes(texts: DataFrame, label: str) -> DataFrame:
    """(key, sorted, nodes, fresh) of (key, sorted), distinct texts: numbers of the nodes along each, from the root on.

    A node has the same number in all texts that share it. The last numbers of the texts ascend as their code points do.
    ``fresh`` says of every code point whether it differs from the one before it.
    """
    dealt = texts.repartitionByRange("sorted").sortWithinPartitions("sorted")
    local = materialise(dealt.mapInArrow(local_nodes, LOCAL), label)
    names = renamed(local.where("edge > 0").select("part", "edge", "sorted", "nodes").collect())

    def rename(batches):
        for batch in batches:
            nodes = batch.column("nodes")
            sizes = np.diff(nodes.offsets.to_numpy())
            flat = nodes.flatten().to_numpy()
            part = np.repeat(batch.column("part").to_numpy(), sizes)
            out = (part << PART_BITS) + flat
            for p in np.unique(part).tolist():
                own = (part == p) & (flat < len(names[p]))
                out[own] = names[p][flat[own]]
            made = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(out, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("sorted"), made, batch.column("fresh")], ["key", "sorted", "nodes", "fresh"])

    return local.select("key", "sorted", "part", "nodes", "fresh").mapInArrow(rename, "key long, sorted string, nodes array<long>, fresh array<boolean>")


SPLIT, SKIP, FRESH_SKIP = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """(prefix, suffix, kind, id, n): the split and the skipped pairs of (id, n, ahead, back, fresh)."""
    size = F.size("fresh")

    def around(i: Column) -> Column:
        prefix = F.get("ahead", i)
        skip = F.struct(prefix.alias("prefix"), F.get("back", size - 1 - i).alias("suffix"), F.when(F.get("fresh", i), FRESH_SKIP).otherwise(SKIP).alias("kind"))
        split = F.struct(prefix.alias("prefix"), F.get("back", size - i).alias("suffix"), F.lit(SPLIT).alias("kind"))
        return F.when(i < size, F.array(split, skip)).otherwise(F.array(split))

    pairs = F.explode(F.flatten(F.transform(F.sequence(F.lit(0), size), around))).alias("pair")
    return words.select("id", "n", pairs).select("pair.prefix", "pair.suffix", "pair.kind", "id", "n")


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are near a word, and the one of largest n, then smallest id, as (n, -id)."""
    is_skip = F.col("kind") > SPLIT
    own = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("other"))
    every = Window.partitionBy("prefix", "suffix")
    ranked = every.orderBy((~is_skip).cast("int"), F.desc("n"), "id")
    skips = F.sum(is_skip.cast("long")).over(every)
    facts = pairs.select(
        "id", "kind", is_skip.alias("is_skip"), skips.alias("skips"),
        F.sum((F.col("kind") == FRESH_SKIP).cast("long")).over(every).alias("longer"),
        F.max(F.when(F.col("kind") == FRESH_SKIP, own)).over(every).alias("best_longer"),
        F.max(F.when(~is_skip, own)).over(every).alias("shorter"),
        F.row_number().over(ranked).alias("rank"),
        F.first(own).over(ranked).alias("best"),
        F.lead(own).over(ranked).alias("second"),
    )
    replaced = F.when(F.col("skips") > 1, F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("best")))
    shortened = F.when(F.col("kind") == FRESH_SKIP, F.col("shorter"))
    found = facts.select(
        "id",
        F.when(F.col("is_skip"), F.col("skips") - 1 + shortened.isNotNull().cast("long")).otherwise(F.col("longer")).alias("near"),
        F.when(F.col("is_skip"), F.greatest(replaced, shortened)).otherwise(F.col("best_longer")).alias("best"),
    )
    return found.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots_of(links: DataFrame, rounds: int) -> DataFrame:
    """(id, root) of links (id, form): the end of the chain that begins at each id; every round doubles the steps taken."""
    now = links.select("id", F.col("form").alias("root"))
    for _ in range(rounds):
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("ahead"))
        now = materialise(now.join(ahead, "root", "left").select("id", F.coalesce("ahead", "root").alias("root")), "roots")
    return now


def spelling_variants(words: DataFrame, word_column: str = "word", count_column: str = "n") -> DataFrame:
    """Per word: word, n, form and root (words), n_near and form_n; ``words`` are distinct, with how often each occurs.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. The form of a word is its
    near word of largest n, ties going to the smaller in code-point order, if that n is 5 or more times the word's (and
    more than it); else null. Following forms to the last one gives the root, the word itself if it has none. ``n_near`` counts near words.
    Rows with a null word are left out, rows of one word add up, a null count is 0; the empty word counts as any other. An
    empty table gives none. Other columns are not read.
    """
    counted = words.where(F.col(word_column).isNotNull()).groupBy(F.col(word_column).cast("string").alias("word"))
    counted = materialise(counted.agg(F.sum(F.coalesce(F.col(count_column).cast("long"), F.lit(0))).alias("n")), "words")
    ahead = trie_nodes(counted.select(F.col("n").alias("key"), F.col("word").alias("sorted")), "prefixes")
    ahead = ahead.select(F.element_at("nodes", -1).alias("id"), F.col("sorted").alias("word"), F.col("key").alias("n"), F.col("nodes").alias("ahead"), "fresh")
    ahead = materialise(ahead, "numbered")
    back = trie_nodes(ahead.select(F.col("id").alias("key"), F.reverse("word").alias("sorted")), "suffixes")
    back = back.select(F.col("key").alias("id"), F.col("nodes").alias("back"))
    near = near_words(node_pairs(ahead.select("id", "n", "ahead", "fresh").join(back, "id")))

    known = ahead.select("id", "word", "n").join(near, "id", "left")
    has_form = (F.col("best.n") >= FORM_TIMES * F.col("n")) & (F.col("best.n") > F.col("n"))
    formed = known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, -F.col("best.other")).alias("form_id"), F.when(has_form, F.col("best.n")).alias("form_n"))
    formed = materialise(formed, "formed")
    links = formed.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form"))
    most = formed.agg(F.max("form_n")).first()[0] or 1
    # every step multiplies the count by FORM_TIMES at least; from a count of 0 a first step may lead anywhere
    steps = 2 + math.ceil(math.log(max(most, 1), FORM_TIMES))
    roots = roots_of(links, math.ceil(math.log2(steps)))

    spelled = ahead.select(F.col("id").alias("other"), F.col("word").alias("spelled"))
    forms = links.join(spelled.withColumnRenamed("spelled", "form_word"), F.col("form") == F.col("other")).select("id", F.col("form_word").alias("form"))
    ends = roots.join(spelled.withColumnRenamed("spelled", "root_word"), F.col("root") == F.col("other")).select("id", F.col("root_word").alias("root"))
    out = formed.join(forms, "id", "left").join(ends, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
