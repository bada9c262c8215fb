"""Quality rules, line first: lines that fail a rule are taken out, and documents that lose too much text are rejected.

Everything is decided within a document, so one pass without a shuffle does it; numpy works on portions of a few MB.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.rows import with_text_columns
from tidemark.llm.texts import mixed, split_words, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
MARKS = re.compile(rb"[!-/:-@\[-`{-~]")  # ASCII punctuation and symbols
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
REPEAT_WIDTH = 5


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; a line without words passes.

    punctuation: more than ``marks`` punctuation marks or symbols per 2 words. navigation: a ``1/separator_share`` of the
    words or more are separators. boilerplate: one of the phrases, ASCII letters in any case, in a line of at most
    ``boilerplate_words`` words. A document is rejected if its failed lines hold over ``lost_percent`` of its word
    characters.
    """

    marks: int = 3
    separators: Sequence[str] = ("|", "»", "›", ">", "/")
    separator_share: int = 4
    phrases: Sequence[str] = (
        "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here",
        "read more", "share this", "sign in", "log in", "subscribe to", "lorem ipsum", "enable javascript",
    )
    boilerplate_words: int = 15
    lost_percent: int = 30


RULES = LineRules()

ADDED = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        *(T.StructField(n, T.LongType()) for n in ("punctuation_lines", "navigation_lines", "boilerplate_lines")),
        T.StructField("lost_chars", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("clean_text", T.StringType()),
    ]
)


class LineJudge:
    """Decides on one line; returns the rule it fails, or None."""

    def __init__(self, rules: LineRules):
        self.rules = rules
        self.separators = {s.encode() for s in rules.separators}
        self.phrases = [p.lower().encode() for p in rules.phrases]

    def __call__(self, line: bytes, words: list[bytes]) -> str | None:
        rules, n = self.rules, len(words)
        if 2 * len(MARKS.findall(line)) > rules.marks * n:
            return "punctuation"
        separators = sum(w in self.separators for w in words)
        if separators and rules.separator_share * separators >= n:
            return "navigation"
        if n <= rules.boilerplate_words:
            low = line.lower()  # of bytes: ASCII letters only
            if any(p in low for p in self.phrases):
                return "boilerplate"
        return None


def repeated_words(texts: list[bytes], width: int = REPEAT_WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words, code points in words, and words inside windows that the text has twice or more."""
    words = split_words(texts)
    first, counts = words.first, np.diff(words.first)
    inside = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    points = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((words.data & 0xC0) != 0x80)
    bounds = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    chars = np.add.reduceat(points, bounds[:-1], dtype=np.int64) if texts else np.zeros(0, np.int64)

    every = window_hashes(word_hashes(words), width)
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(every))
    at = at[owner[at] == owner[at + width - 1]] if len(at) else at
    keys = mixed(every[at] + mixed(owner[at].astype(np.uint64) + np.uint64(1)))  # equal only within a text
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    depth = np.zeros(len(owner) + 1, np.int64)
    np.add.at(depth, again, 1)
    np.add.at(depth, again + width, -1)
    covered = np.r_[0, np.cumsum(np.cumsum(depth[:-1]) > 0)]
    return counts, chars, covered[first[1:]] - covered[first[:-1]]


def judged(texts: list[bytes], judge: LineJudge) -> list[pa.Array]:
    counts, chars, repeats = repeated_words(texts)
    columns = {n: [] for n in ADDED.names[2:]}
    for text, n_words, n_chars, n_repeat in zip(texts, counts.tolist(), chars.tolist(), repeats.tolist(), strict=True):
        failed, lost, kept_lines, seen, duplicates = dict.fromkeys(("punctuation", "navigation", "boilerplate"), 0), 0, [], set(), 0
        for line in text.split(b"\n"):
            words = WORD_BYTES.findall(line)
            if words:
                duplicates += line in seen
                seen.add(line)
                if rule := judge(line, words):
                    failed[rule] += 1
                    lost += len(b"".join(words).decode())
                    continue
            kept_lines.append(line)
        base_failed = n_words < 10 or 100 * n_repeat > 20 * n_words
        values = (
            sum(map(text.count, (bytes([x]) for x in SYMBOLS))), duplicates, n_repeat, *failed.values(), lost, base_failed,
            not base_failed and 100 * lost <= judge.rules.lost_percent * n_chars, b"\n".join(kept_lines),
        )
        for column, value in zip(columns.values(), values, strict=True):
            column.append(value)
    arrays = [pa.array(counts, pa.int64()), pa.array(chars, pa.int64())]
    kinds = {"base_failed": pa.bool_(), "kept": pa.bool_(), "clean_text": pa.binary()}
    arrays += [pa.array(v, kinds.get(n, pa.int64())) for n, v in columns.items()]
    return [*arrays[:-1], arrays[-1].cast(pa.string())]


def quality_rules(docs: DataFrame, text_column: str = "text", rules: LineRules = RULES) -> DataFrame:
    """The documents with their measures, the verdict ``kept`` and ``clean_text``, the text without its failed lines.

    ``n_words`` and ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an
    earlier one), ``n_repeat_words`` (words in 5-word windows found twice or more); lines failing by rule, and
    ``lost_chars``, the word characters in them. ``base_failed``: under 10 words, or over 20 % repeated words. Lines end
    at line feeds. A null text counts as empty: base_failed. Every row is answered for, repeated rows alike; other
    columns stay, ones named like a result are replaced.
    """
    judge = LineJudge(rules)
    return with_text_columns(docs, text_column, ADDED, lambda texts: judged(texts, judge))
