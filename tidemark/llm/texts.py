"""Helpers shared by the operators on texts: byte-balanced portions of Arrow batches and words as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A word of a text: every run of bytes other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task holds as numpy arrays at a time; one longer text is taken whole, its words in pieces.
PORTION_BYTES = 2 << 20


def portions(batches: Iterable[pa.RecordBatch], column: str, most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``most`` bytes of text; a longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts as UTF-8; a null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class Words(NamedTuple):
    """Words of several texts: they lie in ``data`` from ``starts`` to ``ends``; text i has words first[i]:first[i+1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def split_words(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    gap = np.ones(len(data) + 1, np.int8)
    gap[1:] = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(gap)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return Words(data, starts, ends, np.searchsorted(starts, begin))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _byte_codes(seed: int) -> np.ndarray:
    return mixed((np.arange(256, dtype=np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15))


#: Values hashed at a time. The tables of powers have this length, whatever the length of a text or word.
PIECE = 1 << 17


@lru_cache(maxsize=4)
def powers(base: int) -> np.ndarray:
    """base**0 ... base**PIECE modulo 2**64."""
    out = np.full(PIECE + 1, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Odd multipliers of the polynomial hashes; odd numbers have an inverse modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E6C63D0876A9A63, 0xD1342543DE82EF95


def _polynomials(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Sums of values[start + i] * base**i over start:end, modulo 2**64; at most PIECE values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base)[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64))[starts]


def rolling(values: Callable[[int, int], np.ndarray], starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp: the polynomial hash of the values from start to end for every pair, both ascending.

    ``values(a, b)`` gives the values of a stretch. They are taken in pieces of bounded length, and a longer stretch than
    that is summed piece by piece, so memory follows neither the longest word nor the longest text.
    """
    out, at, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while at < n:
        begin = int(starts[at])
        stop = int(np.searchsorted(ends, begin + PIECE, side="right"))
        if stop > at:
            piece = values(begin, int(ends[stop - 1]))
            out[at:stop] = _polynomials(piece, starts[at:stop] - begin, ends[at:stop] - begin, base)
        else:
            stop, total, factor = at + 1, 0, 1
            for a in range(begin, int(ends[at]), PIECE):
                piece = values(a, min(a + PIECE, int(ends[at])))
                total += factor * int(_polynomials(piece, np.zeros(1, np.int64), np.array([len(piece)]), base)[0])
                factor = factor * pow(base, PIECE, 1 << 64) % (1 << 64)
            out[at] = total % (1 << 64)
        at = stop
    return mixed(out)


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    codes = _byte_codes(seed)
    return rolling(lambda a, b: codes[words.data[a:b]], words.starts, words.ends, BYTE_BASE)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``width`` consecutive words; entry i begins at word i."""
    at = np.arange(max(0, len(hashes) - width + 1))
    return rolling(lambda a, b: hashes[a:b], at, at + width, WORD_BASE)
