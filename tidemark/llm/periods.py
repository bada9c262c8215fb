"""Periodic runs: stretches of words that repeat with a period, at least four times.

A run of period q is a maximal stretch in which words q apart are identical. It is seen as its match interval, the places
i with word[i] == word[i + q], which is q shorter.

How it runs. A text is exploded into overlapping tiles per octave of periods, q in [b, 2b) for b = 1, 2, 4 ...; the tiles
of the short octaves coincide, so a text of a few thousand words is a single tile. A tile is solved without looking at any
other: words are hashed, and blocks of b words, beginning at every multiple of b, are compared with the blocks q behind
them. A match interval of a run is at least 3b long and holds two such blocks in a row. From the outer boundaries of a row
of equal blocks, the values of two Z-functions (how far do the words before, or behind, the boundary match those q behind
them) give the ends of the interval. Tiles share 6b places, so an interval is seen whole in one of them or long enough in
each for its fragments to overlap. Fragments are shuffled by document and period and stitched where they touch; of
intervals with the same ends the one with the smallest period stays, since a longer one is a multiple of it.

Texts never cross the network for that, but those of very long documents: their tiles are dealt out, so that no task
solves all of them. The fragments are few and small; the texts meet the runs by a join.

Words are compared by 64-bit hashes; two different words share one with a probability of 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.components import with_hash
from tidemark.llm.simhash import LAST
from tidemark.llm.texts import encoded, mixed, portions, split_words, word_hashes

#: A run repeats its period so many times at least, and has so many words at least.
TIMES, LEAST = 4, 6
#: Words of a tile whose octaves need no longer one, besides what it shares with its neighbours.
TILE = 1 << 16
#: Tiles of a longer octave are so many times its shortest period.
TILE_BLOCKS = 16
#: Places on the left and right that a tile shares with its neighbours, in shortest periods of its last octave.
BEFORE, BEHIND = 3, 5
#: Bytes of a text whose tiles are dealt out to tasks of their own.
LONG_TEXT = 8 << 20

TILE_SCHEMA = pa.schema([("place", pa.int64()), ("text_hash", pa.int64()), ("offset", pa.int64()), ("n", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("codes", pa.binary())])
TILES = "place long, text_hash long, offset long, n long, low int, high int, codes binary"
FRAGMENT_SCHEMA = pa.schema([("place", pa.int64()), ("text_hash", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
FRAGMENTS = "place long, text_hash long, period long, start long, stop long"
RUN = "array<struct<start:long,period:long,length:long>>"


@dataclass
class Tile:
    """Words offset:offset+len(codes) of a text of n words; its octaves are 2**low to 2**high, without the last."""

    place: int
    text_hash: int
    offset: int
    n: int
    low: int
    high: int
    codes: np.ndarray


def cuts(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """Tiles of a text of n words: (start, stop, low, high)."""
    octaves = (n // TIMES).bit_length()  # periods are n // TIMES at most
    if n < LEAST:
        return
    if n <= 2 * tile:
        yield 0, n, 0, octaves
        return
    short = min(octaves, max(1, (tile // TILE_BLOCKS).bit_length()))
    for low, high in [(0, short), *((k, k + 1) for k in range(short, octaves))]:
        block = 1 << (high - 1)
        step = max(tile, TILE_BLOCKS * block)
        for start in range(0, n, step):
            yield max(0, start - BEFORE * block), min(n, start + step + BEHIND * block), low, high


def exploded(batches: Iterable[pa.RecordBatch], tile: int) -> Iterator[list[Tile]]:
    """Tiles of the texts, a portion at a time."""
    for part in portions(batches, "text"):
        words = split_words(encoded(part.column("text")))
        hashes = word_hashes(words)
        keys = zip(part.column("place").to_pylist(), part.column("text_hash").to_pylist(), strict=True)
        for (place, text_hash), a, b in zip(keys, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            made = [Tile(place, text_hash, s, b - a, low, high, hashes[a + s : a + e]) for s, e, low, high in cuts(b - a, tile)]
            if made:
                yield made


def gathered(tiles: Iterable[list[Tile]], words: int) -> Iterator[list[Tile]]:
    """Tiles of about so many words together, to be solved by the same array operations; a larger tile comes alone."""
    held: list[Tile] = []
    size = 0
    for some in tiles:
        for tile in some:
            if held and (size + len(tile.codes) > words or tile.low != held[0].low):
                yield held
                held, size = [], 0
            held.append(tile)
            size += len(tile.codes)
    if held:
        yield held


def rows_of_equal_blocks(names: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Periods in [block, 2 * block), and where rows of two or more blocks begin and end that equal those a period behind.

    ``names`` has a number for the block at every place.
    """
    filler = mixed(np.arange(len(names), len(names) + (-len(names)) % block, dtype=np.uint64) + np.uint64(1 << 63))
    grid = np.r_[names, filler].reshape(-1, block)
    equal = np.flatnonzero(grid[1:] == grid[:-1, :1])
    row, more = equal // block, equal % block
    order = np.lexsort((row, more))
    row, more = row[order], more[order]
    follows = np.r_[False, (row[1:] == row[:-1] + 1) & (more[1:] == more[:-1])]
    first = np.flatnonzero(~follows)
    last = np.r_[first[1:], len(row)] - 1
    enough = last > first
    first, last = first[enough], last[enough]
    return more[first] + block, row[first] * block, (row[last] + 1) * block


def multiples(periods: np.ndarray, starts: np.ndarray, stops: np.ndarray, known: list[tuple[int, int, int]]) -> np.ndarray:
    """Which intervals lie in a known one whose period divides theirs; ``starts`` ascend."""
    drop = np.zeros(len(periods), bool)
    for period, start, stop in known:
        a, b = np.searchsorted(starts, (start, stop + period))
        drop[a:b] |= (periods[a:b] % period == 0) & (stops[a:b] + periods[a:b] <= stop + period)
    return drop


def matching(codes: np.ndarray, at: int, period: int, most: int, step: int) -> int:
    """A value of a boundary's Z-function: how many places from ``at`` on, forwards or backwards, match those behind them."""
    n = min(most, len(codes) - period - at) if step > 0 else min(most, at + 1)
    if n <= 0:
        return 0
    if step > 0:
        differ = codes[at : at + n] != codes[at + period : at + period + n]
    else:
        differ = codes[at + 1 - n : at + 1][::-1] != codes[at + 1 - n + period : at + 1 + period][::-1]
    first = int(differ.argmax())
    return first if differ[first] else n


def intervals(codes: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of match intervals that may belong to a run, for the octaves from ``low`` to ``high``."""
    found: list[tuple[int, int, int]] = []
    names = codes
    for k in range(high):
        block = 1 << k
        if len(names) <= block:
            break
        if k >= low:
            periods, starts, stops = rows_of_equal_blocks(names, block)
            order = np.argsort(starts, kind="stable")
            periods, starts, stops = periods[order], starts[order], stops[order]
            new = ~multiples(periods, starts, stops, found)
            for q, s, e in zip(periods[new].tolist(), starts[new].tolist(), stops[new].tolist(), strict=True):
                found.append((q, s - matching(codes, s - 1, q, block, -1), e + matching(codes, e, q, block, 1)))
        names = mixed(names[:-block] * np.uint64(0x9E3779B97F4A7C15) + mixed(names[block:] + np.uint64(k)))
    return found


def solved(tiles: list[Tile]) -> Iterator[pa.RecordBatch]:
    """Fragments of the runs in some tiles of the same first octave. Numbers that occur once stand between tiles."""
    gaps = mixed(np.arange(len(tiles), dtype=np.uint64) + np.uint64(1 << 62))
    codes = np.concatenate([x for t, g in zip(tiles, gaps, strict=True) for x in (t.codes, g[None])])
    begins = np.r_[0, np.cumsum([len(t.codes) + 1 for t in tiles])]
    out = []
    for period, start, stop in intervals(codes, tiles[0].low, max(t.high for t in tiles)):
        i = int(np.searchsorted(begins, start, side="right")) - 1
        tile, a, b = tiles[i], start - begins[i], stop - begins[i]
        cut_left = a == 0 and tile.offset
        cut_right = b + period == len(tile.codes) and tile.offset + len(tile.codes) < tile.n
        if cut_left or cut_right or b - a + period >= max(LEAST, TIMES * period):
            out.append((tile.place, tile.text_hash, period, int(a) + tile.offset, int(b) + tile.offset))
    if out:
        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=FRAGMENT_SCHEMA)


def fragments(rows: DataFrame, tile: int, long_text: int) -> DataFrame:
    """Fragments of the match intervals in the texts of (place, text_hash, text)."""

    def solve_texts(batches):
        memory.begin()
        for tiles in gathered(exploded(batches, tile), 4 * TILE):
            yield from solved(tiles)

    def explode(batches):
        memory.begin()
        for tiles in exploded(batches, tile):
            for t in tiles:
                values = [t.place, t.text_hash, t.offset, t.n, t.low, t.high, t.codes.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, TILE_SCHEMA, strict=True)], schema=TILE_SCHEMA)

    def solve_tiles(batches):
        memory.begin()
        for batch in batches:
            for row in batch.to_pylist():
                yield from solved([Tile(**row | {"codes": np.frombuffer(row["codes"], np.uint64)})])

    size = F.octet_length("text")
    whole = rows.where(size <= long_text).mapInArrow(solve_texts, FRAGMENTS)
    tiles = rows.where(size > long_text).mapInArrow(explode, TILES)
    dealt = tiles.repartition("place", "text_hash", "low", "offset")
    return whole.unionByName(dealt.mapInArrow(solve_tiles, FRAGMENTS))


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs (place, text_hash, start, period, length) from the fragments of their match intervals."""
    key = ["place", "text_hash", "period"]
    before = Window.partitionBy(*key).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy(*key).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("start") > F.max("stop").over(before), F.lit(True))
    numbered = pieces.withColumn("opens", opens.cast("long")).withColumn("nth", F.sum("opens").over(up_to))
    whole = numbered.groupBy(*key, "nth").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = (F.col("stop") - F.col("start") + F.col("period")).alias("length")
    runs = whole.select(*key, "start", length).where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    return runs.groupBy("place", "text_hash", "start", "length").agg(F.min("period").alias("period"))


def collapsed(text: bytes, runs: list[dict] | None) -> bytes:
    """The words of a text, joined by one space, without those that a run holds behind its first period."""
    words = text.split()  # of bytes: ASCII white space only
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for run in runs:
            depth[run["start"] + run["period"]] += 1
            depth[run["start"] + run["length"]] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tile: int = TILE, long_text: int = LONG_TEXT
) -> DataFrame:
    """Per document: doc_id, runs (start, period and length in words, by start, then period) and collapsed_text.

    Words are separated by ASCII white space. A run is a stretch of words with smallest period q, of at least 4 * q and 6
    words, that no neighbouring word extends. ``collapsed_text`` has the words that no run holds behind its first q words,
    joined by one space. Null text: no words, no runs, empty. Rows that share an id or have none, and equal rows, are each
    answered for. An empty table gives none. Other columns are not read.
    """
    place = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("place")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), place, F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    runs = stitched(fragments(rows.select("place", "text_hash", "text"), tile, long_text))
    of_text = runs.groupBy("place", "text_hash", with_hash("text_hash"))
    of_text = of_text.agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    both = rows.join(of_text.drop("key_hash"), ["place", "text_hash"], "left").select("doc_id", "text", "runs")

    def collapse(batches):
        memory.begin()
        for part in portions(batches, "text"):
            found = part.column("runs").to_pylist()
            texts = [collapsed(t, r) for t, r in zip(encoded(part.column("text")), found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("runs"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed_text"]
            )

    made = both.mapInArrow(collapse, f"doc_id long, runs {RUN}, collapsed_text string")
    return made.withColumn("runs", F.coalesce("runs", F.array().cast(RUN)))
