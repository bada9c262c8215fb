"""Secret scans: patterns of three kinds, and a linear-chain conditional random field for what no pattern states.

The field labels the tokens of a text as outside, begin or inside of a secret. A token's score is a sum of weights of its
shape (length, classes of characters and how often they alternate, vowels, variety), of its spelling and that of its
neighbours (three before, one behind), and of its text as a whole (how much of it is not prose, whether it looks like
code) together with the shape; neighbouring labels have weights of their own. The best labels are found by Viterbi.

Training runs on the driver over ``SAMPLE_ROWS`` windows of ``SAMPLE_LETTERS`` characters, taken at places that a hash
chooses, from the rows with the smallest hashes. Their labels come from the patterns, and from secrets and harmless
look-alikes that are made up and put into the windows. The sample is the only thing bounded; every text is scanned whole.

Scanning is one pass without a shuffle. Features are computed once per distinct token of a portion, and Viterbi runs over
all blocks of a portion at the same time: a block is solved for each label it may be entered with, then blocks are chained.
"""

from __future__ import annotations

import random
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.rows import with_text_columns
from tidemark.llm.texts import Words, mixed, word_hashes

#: Fixed patterns, by kind; case of letters counts in the second and third only. Matches that are too short are dropped.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # a maximal run, like every match of one or more
KINDS = ("assign", "access", "hex", "crf")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

SAMPLE_ROWS, SAMPLE_LETTERS = 1200, 160
OUTSIDE, BEGIN, INSIDE = range(3)
#: Tokens before and behind one whose spelling counts.
BEFORE, BEHIND = 3, 1
OFFSETS = range(-BEFORE, BEHIND + 1)
#: Tokens of a block that Viterbi walks through together with all other blocks.
BLOCK = 64
FOUND = T.StructType([T.StructField("secrets", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("stop", T.LongType())])))])
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("stop", pa.int64())]))


def pattern_spans(text: bytes) -> list[tuple[int, str, int]]:
    """(start, kind, stop) of the matches, in bytes; kinds are looked for apart from each other."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def secret_parts(text: bytes) -> list[tuple[int, int]]:
    """What the patterns hold for secret: the value alone of an assignment."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    return parts + [(a, b) for a, kind, b in pattern_spans(text) if kind != "assign"]


# -- tokens and their features -----------------------------------------------------------------------------------------

RUN, ALONE = 1, 2
_CLASS = np.full(256, ALONE, np.uint8)
_CLASS[[32, *range(9, 14)]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-", *range(128, 256)]] = RUN


def tokens(texts: list[bytes]) -> Words:
    """Runs of letters, digits, ``+/_.-`` and bytes beyond ASCII, and runs of the same other visible character."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = np.where(_CLASS[data] == ALONE, data.astype(np.int16) + ALONE, _CLASS[data])  # each of them a class of its own
    edge = np.r_[True, kind[1:] != kind[:-1], True]
    starts, ends = np.flatnonzero(edge[:-1] & (kind > 0)), np.flatnonzero(edge[1:] & (kind > 0)) + 1
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return Words(data, starts, ends, np.searchsorted(starts, begin))


LOWER, UPPER, DIGIT, OTHER, WIDE = range(5)
_KIND = np.array([UPPER if 65 <= b < 91 else LOWER if 97 <= b < 123 else DIGIT if 48 <= b < 58 else WIDE if b > 127 else OTHER for b in range(256)], np.int8)
_LOW = np.array([b + 32 if 65 <= b < 91 else b for b in range(256)], np.uint8)
_VOWEL, _HEX = (np.isin(np.arange(256), list(x)) for x in (b"aeiouyAEIOUY", b"0123456789abcdefABCDEF"))
#: Numbers of features: padding and bias, eight shapes of up to 64 values, spellings of short and beginnings of long tokens.
SHAPES, SPELLINGS, BEGINNINGS = 64, 2048, 1024
N_FEATURES = 2 + 8 * SHAPES + SPELLINGS + BEGINNINGS
PER_TOKEN = 10
PAD, BIAS = 0, 1
#: Bytes of a token up to which its spelling counts; of a longer one the first four count.
SPELLED = 16
#: A text's features: four shares of tokens that are not prose, with or without marks of code, for each shape.
FILE_KINDS, FILE_SHAPES = 8, 64
CODE = re.compile(rb"[{};]|=>|::|#!|</")


def features(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PER_TOKEN feature numbers of each chosen token, and whether it may be a word of prose."""
    data, a, b = words.data, words.starts[at], words.ends[at]
    n, kinds = b - a, _KIND[words.data]

    def count(flags: np.ndarray, begin: np.ndarray = a) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return sums[b] - sums[begin]

    of_kind = [count(kinds == k) for k in range(5)]
    present = sum((c > 0) << k for k, c in enumerate(of_kind))
    changes = count(np.r_[False, kinds[1:] != kinds[:-1]], a + 1)
    digit = kinds == DIGIT
    swaps = count(np.r_[False, digit[1:] != digit[:-1]], a + 1)
    size = np.where(n < 8, n, 8 + (np.minimum(n, 40) - 8) // 4)  # to 16
    wide = np.minimum(n // 8, 3)
    values = [
        size,
        present,
        np.minimum(changes, 15) + 16 * (n >= 16),
        np.minimum(swaps, 15) + 16 * wide,
        count(_VOWEL[data]) * 7 // n + 8 * wide,
        (count(_HEX[data]) == n) + 2 * size,
        of_kind[DIGIT] * 7 // n + 8 * wide,
        (present & 7) + 8 * np.minimum(n // 6, 7),
    ]
    low = word_hashes(Words(_LOW[data], a, b, words.first), seed=7)
    first = np.zeros(len(at), np.uint64)
    for i in range(4):
        first = first * np.uint64(257) + data[np.minimum(a + i, b - 1)]
    spelling = np.where(n <= SPELLED, low % np.uint64(SPELLINGS), SPELLINGS + mixed(first) % np.uint64(BEGINNINGS)).astype(np.int64)
    columns = [np.full(len(at), BIAS), *(2 + SHAPES * i + np.minimum(v, SHAPES - 1) for i, v in enumerate(values))]
    table = np.stack([*columns, 2 + 8 * SHAPES + spelling], axis=1).astype(np.int32)
    return table, (of_kind[LOWER] + of_kind[UPPER] == n) | (of_kind[WIDE] > 0)


class Tokens(NamedTuple):
    """Tokens of several texts in one row, with padding before, between and behind the texts."""

    words: Words
    table: np.ndarray  # features of each distinct token, the padding first
    ids: np.ndarray  # by place, 0 where there is padding
    places: np.ndarray  # of each token
    file: np.ndarray  # the text's kind, by place
    shape: np.ndarray  # of each distinct token
    begins: np.ndarray  # bytes before each text


def prepared(texts: list[bytes]) -> Tokens:
    words = tokens(texts)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), counts)
    _, first, inverse = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    order = np.argsort(first)  # in the order of their first places, as hashing in pieces wants them
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    table = np.zeros((len(first) + 1, PER_TOKEN), np.int32)
    prose = np.zeros(len(first) + 1, bool)
    table[1:], prose[1:] = features(words, first[order])
    places = np.arange(len(owner)) + BEFORE * (owner + 1)
    ids = np.zeros(len(owner) + BEFORE * (len(texts) + 1), np.int64)
    ids[places] = rank[inverse] + 1
    other = np.bincount(owner, ~prose[ids[places]], minlength=len(texts)) / np.maximum(counts, 1)
    kind = np.digitize(other, [0.1, 0.25, 0.5]) * 2 + np.array([CODE.search(t) is not None for t in texts], np.int64)
    file = np.zeros(len(ids), np.int64)
    file[places] = kind[owner]
    shape = np.minimum(table[:, -2] - (2 + 7 * SHAPES), FILE_SHAPES - 1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return Tokens(words, table, ids, places, file, np.maximum(shape, 0), begins)


class Field(NamedTuple):
    """Weights: of features by offset and label, of a text's kind with a shape by label, and of label after label."""

    weights: np.ndarray
    file: np.ndarray
    steps: np.ndarray

    def scores(self, t: Tokens) -> np.ndarray:
        """A score for every place and label; padding is outside."""
        out = self.file[t.file, t.shape[t.ids]]
        for o, w in zip(OFFSETS, self.weights, strict=True):
            own = w[t.table].sum(axis=1)[t.ids]
            if o < 0:
                out[-o:] += own[:o]
            elif o:
                out[:-o] += own[o:]
            else:
                out += own
        out[t.ids == 0] = (0, -np.inf, -np.inf)
        return out


def allowed(steps: np.ndarray) -> np.ndarray:
    """Nothing is inside a secret that did not begin."""
    out = steps.copy()
    out[OUTSIDE, INSIDE] = -np.inf
    return out


def viterbi(scores: np.ndarray, steps: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The labels of the best path, which comes from outside."""
    n = len(scores)
    blocks = -(-n // block)
    padded = np.full((blocks * block, 3), -np.inf, scores.dtype)
    padded[len(padded) - n :] = scores
    padded[: len(padded) - n, OUTSIDE] = 0  # in front, where it changes nothing
    grid = padded.reshape(blocks, block, 3)
    best = steps[None] + grid[:, 0, None, :]  # by block: from the label it is entered with to the label reached
    back = np.zeros((block, blocks, 3, 3), np.int8)
    for i in range(1, block):
        ways = best[:, :, :, None] + steps[None, None]
        back[i] = ways.argmax(axis=2)
        best = ways.max(axis=2) + grid[:, i, None, :]
    so_far, entered = np.array([0, -np.inf, -np.inf]), np.zeros((blocks, 3), np.int8)
    for b in range(blocks):
        ways = so_far[:, None] + best[b]
        entered[b] = ways.argmax(axis=0)
        so_far = ways.max(axis=0)
    label = int(so_far.argmax())
    last, come = np.zeros(blocks, np.int8), np.zeros(blocks, np.int8)
    for b in range(blocks - 1, -1, -1):
        last[b], come[b] = label, entered[b, label]
        label = int(come[b])
    out, every = np.zeros((blocks, block), np.int8), np.arange(blocks)
    out[:, -1] = last
    for i in range(block - 1, 0, -1):
        out[:, i - 1] = back[i][every, come, out[:, i]]
    return out.ravel()[out.size - n :]


def labelled_spans(t: Tokens, labels: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per text, the byte spans of its secrets."""
    own = labels[t.places]
    begins = np.flatnonzero(own == BEGIN)
    out: list[list[tuple[int, int]]] = [[] for _ in t.words.first[1:]]
    if not len(begins):
        return out
    rest = np.flatnonzero(own != INSIDE)
    stops = np.r_[rest, len(own)][np.searchsorted(rest, begins, side="right")]
    owner = np.searchsorted(t.words.first, begins, side="right") - 1
    stops = np.minimum(stops, t.words.first[owner + 1])
    starts, ends = t.words.starts[begins] - t.begins[owner], t.words.ends[stops - 1] - t.begins[owner]
    for i, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
        out[i].append((a, b))
    return out


# -- training ----------------------------------------------------------------------------------------------------------

#: Names of settings that hold secrets, and of others; ways to join a name and a value.
SECRET_NAMES = "password passwd secret token api_key apikey API_KEY pwd pass auth_key access_key client_secret private_key credential DB_PASSWORD SECRET_KEY Authorization Bearer".split()
OTHER_NAMES = "name version path host port user title color width date file level mode size status encoding".split()
JOINS = [" = ", "=", ": ", ":", '": "', " is "]
#: Beginnings of well-known access tokens, with the number of characters that follow.
PREFIXES = {"ghp_": 36, "sk_live_": 24, "xoxb-": 40, "AIza": 35, "AKIA": 16, "glpat-": 20, "eyJ": 60}
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
MIXED = DIGITS + LETTERS + LETTERS.upper()


def made_secret(rng: random.Random) -> str:
    kind = rng.randrange(5)
    if kind == 0:
        return "".join(rng.choices(rng.choice([DIGITS + "abcdef", DIGITS + "ABCDEF"]), k=rng.choice([16, 20, 32, 40, 64])))
    if kind == 1:
        return "".join(rng.choices(MIXED + "+/", k=rng.randrange(20, 60))) + rng.choice(["", "=", "=="])
    if kind == 2:
        prefix, n = rng.choice(sorted(PREFIXES.items()))
        return prefix + "".join(rng.choices(MIXED.upper() if prefix == "AKIA" else MIXED, k=n))
    if kind == 3:
        return "".join(rng.choices(MIXED, k=rng.randrange(16, 48)))
    return "".join(rng.choices(LETTERS, k=rng.randrange(3, 7))) + rng.choice("!_-#") + "".join(rng.choices(MIXED, k=rng.randrange(4, 9)))


def planted(rng: random.Random, word: str) -> tuple[str, tuple[int, int] | None]:
    """A secret with what stands before it and the span of the secret; or something that only looks like one."""
    if rng.random() < 0.6:
        value, named = made_secret(rng), rng.random() < 0.8
        # a short secret cannot be told without its name
        if not named and len(value) < 16:
            named = True
        before = rng.choice(SECRET_NAMES) + rng.choice(JOINS) if named else ""
        quote = rng.choice(["", "", '"', "'"])
        before += "" if before.endswith('"') else quote
        return before + value + quote, (len(before), len(before) + len(value))
    harmless = [
        f"{rng.choice(OTHER_NAMES)}{rng.choice(JOINS)}{rng.choice([word, str(rng.randrange(10**6)), 'v%d.%d.%d' % tuple(rng.choices(range(20), k=3))])}",
        f"the {rng.choice(['token', 'secret', 'password', 'key'])} {word}",
        f"https://www.{word}.org/{word}/{rng.choice(LETTERS)}{word}.html",
        f"{word}.{rng.choice([word, str(rng.randrange(100))])}@{word}{rng.choice(['', str(rng.randrange(10))])}.{rng.choice([word + '.', ''])}com",
        f"{rng.randrange(100)}@{word}{rng.randrange(10)}.{word}.com",
        "".join(rng.choices(DIGITS, k=rng.randrange(4, 17))),
        f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}",
        f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-{rng.randrange(10, 28)}T{rng.randrange(10, 23)}:{rng.randrange(10, 59)}:00Z",
        word * rng.randrange(2, 5),
        "-".join([word] * rng.randrange(2, 5)),
        word.upper() + rng.choice(["", "_", "."]) + word.title(),
    ]
    return rng.choice(harmless), None


def labelled(windows: list[str], seed: int = 0) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Windows with secrets put into most of them, and the byte spans of all their secrets."""
    rng, out = random.Random(seed), []
    for window in windows:
        text, spans = window.encode(), []
        if rng.random() < 0.75:
            gaps = [m.end() for m in re.finditer(rb"[\x20\x09-\x0D]+", text)] or [len(text)]
            words = [w for w in re.findall(r"[A-Za-z]{3,12}", window)] or ["word"]
            made, span = planted(rng, rng.choice(words))
            at, new = rng.choice(gaps), made.encode()
            text = text[:at] + new + rng.choice([b" ", b"\n", b", ", b"; "]) + text[at:]
            if span:
                spans.append((at + len(made[: span[0]].encode()), at + len(made[: span[1]].encode())))
        out.append((text, spans + secret_parts(text)))
    return out


def gold(t: Tokens, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """The labels that the spans give, by place."""
    own = np.zeros(len(t.places), np.int8)
    for i, some in enumerate(spans):
        a, b = t.words.first[i : i + 2]
        for start, stop in sorted(set(some)):
            lo = a + int(np.searchsorted(t.words.ends[a:b], start + t.begins[i], side="right"))
            hi = a + int(np.searchsorted(t.words.starts[a:b], stop + t.begins[i]))
            if hi > lo and not own[lo:hi].any():
                own[lo:hi], own[lo] = INSIDE, BEGIN
    out = np.zeros(len(t.ids), np.int8)
    out[t.places] = own
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(scores: np.ndarray, steps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels by place, and expected numbers of steps from label to label.

    ``at`` has the places of each sequence in a row, all of one length. Sequences begin after an outside label.
    """
    low = -1e9
    scores, steps = np.maximum(scores[at], low), np.maximum(steps, low)
    n, length = at.shape
    ahead, behind = np.zeros((length, n, 3)), np.zeros((length, n, 3))
    ahead[0] = steps[OUTSIDE] + scores[:, 0]
    for i in range(1, length):
        ahead[i] = _log_sum(ahead[i - 1][:, :, None] + steps, 1) + scores[:, i]
    for i in range(length - 2, -1, -1):
        behind[i] = _log_sum(steps + (scores[:, i + 1] + behind[i + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    labels = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)
    pairs = ahead[:-1, :, :, None] + steps + (scores.transpose(1, 0, 2)[1:] + behind[1:])[:, :, None, :]
    return labels, np.exp(pairs - total[None, :, None, None]).sum(axis=(0, 1))


def trained(windows: list[str], seed: int = 0, rounds: int = 40, rate: float = 0.3, decay: float = 3e-4) -> Field:
    """A field fitted to labelled windows by conditional likelihood, with Adam over all windows at a time."""
    examples = labelled(windows, seed)
    weights, file, steps = np.zeros((len(OFFSETS), N_FEATURES, 3)), np.zeros((FILE_KINDS, FILE_SHAPES, 3)), np.zeros((3, 3))
    if not examples:
        return Field(weights.astype(np.float32), file.astype(np.float32), allowed(steps))
    t = prepared([text for text, _ in examples])
    target = gold(t, [spans for _, spans in examples])
    # sequences of equal length: a window's tokens with padding behind, which is outside
    counts = np.diff(t.words.first)
    firsts = t.words.first[:-1] + BEFORE * np.arange(1, len(counts) + 1)
    at = firsts[:, None] + np.arange(max(1, counts.max()))
    real = np.arange(at.shape[1]) < counts[:, None]
    at = np.where(real, at, 0)  # the first place is padding
    wanted = np.eye(3)[target]
    goal = np.zeros((3, 3))
    np.add.at(goal, (target[at[:, :-1]].ravel(), target[at[:, 1:]].ravel()), 1)
    moments = [[np.zeros_like(x) for x in (weights, file, steps)] for _ in range(2)]
    n = len(examples)
    for i in range(1, rounds + 1):
        labels, pairs = marginals(Field(weights, file, steps).scores(t), allowed(steps), at)
        slope = np.zeros((len(t.ids), 3))
        slope[at[real]] = (wanted[at] - labels)[real]
        gradients = [np.zeros_like(weights), np.zeros_like(file), (goal - pairs) / n]
        for k, o in enumerate(OFFSETS):
            moved = np.zeros_like(slope)
            if o < 0:
                moved[:o] = slope[-o:]
            elif o:
                moved[o:] = slope[:-o]
            else:
                moved = slope
            for y in range(3):
                of_id = np.bincount(t.ids, moved[:, y], minlength=len(t.table))
                gradients[0][k, :, y] = np.bincount(t.table.ravel(), np.repeat(of_id, PER_TOKEN), minlength=N_FEATURES) / n
        for y in range(3):
            flat = np.bincount(t.file * FILE_SHAPES + t.shape[t.ids], slope[:, y], minlength=FILE_KINDS * FILE_SHAPES)
            gradients[1][:, :, y] = flat.reshape(FILE_KINDS, FILE_SHAPES) / n
        for x, g, m, v in zip((weights, file, steps), gradients, *moments, strict=True):
            g -= decay * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
    return Field(weights.astype(np.float32), file.astype(np.float32), allowed(steps))


# -- Spark -------------------------------------------------------------------------------------------------------------


def sample(docs: DataFrame, text_column: str, rows: int, letters: int, seed: int) -> list[str]:
    """Windows of the rows with the smallest hashes, each at a place that the hash chooses."""
    h = F.xxhash64(F.lit(seed), text_column)
    last = F.greatest(F.lit(0), F.length(text_column) - letters)
    window = F.substring(F.col(text_column), (1 + F.pmod(F.xxhash64(h), last + 1)).cast("int"), F.lit(letters))
    chosen = docs.where(F.length(text_column) > 0).select(h.alias("h"), window.alias("window")).distinct()
    return [r.window for r in chosen.orderBy("h", "window").limit(rows).collect()]


def scanned(texts: list[bytes], field: Field) -> list[list[tuple[int, str, int]]]:
    """(start, kind, stop) in code points, of the patterns and of the field's secrets that touch none of them."""
    t = prepared(texts)
    labels = viterbi(field.scores(t), field.steps)
    out = []
    for text, more in zip(texts, labelled_spans(t, labels), strict=True):
        found = pattern_spans(text)
        found += [(a, "crf", b) for a, b in more if not any(a < e and s < b for s, _, e in found)]
        found.sort(key=lambda x: (x[0], KINDS.index(x[1])))
        if not text.isascii():
            edges = sorted({x for s, _, e in found for x in (s, e)})
            points, before, so_far = {}, 0, 0
            for edge in edges:
                so_far += len(text[before:edge].decode())
                points[edge], before = so_far, edge
            found = [(points[s], kind, points[e]) for s, kind, e in found]
        out.append(found)
    return out


def secret_scan(docs: DataFrame, text_column: str = "text", field: Field | None = None, seed: int = 0, sample_rows: int = SAMPLE_ROWS, sample_letters: int = SAMPLE_LETTERS) -> DataFrame:
    """The documents with ``secrets``: (start, kind, stop) in code points, by start, then kind as listed in ``KINDS``.

    "assign", "access" and "hex" are the matches of the patterns, whole; "crf" are secrets of the field that touch none of
    those. Without a ``field`` one is trained on a sample of ``sample_rows`` windows of the same documents; equal tables
    give equal fields. Null and empty texts have none; repeated rows are scanned each; a column of that name is replaced.
    An empty table gives none.
    """
    own = field or trained(sample(docs, text_column, sample_rows, sample_letters, seed), seed)

    def compute(texts: list[bytes]) -> list[pa.Array]:
        found = scanned(texts, own)
        return [pa.array([[{"start": s, "kind": k, "stop": e} for s, k, e in some] for some in found], SPAN_TYPE)]

    return with_text_columns(docs, text_column, FOUND, compute)
