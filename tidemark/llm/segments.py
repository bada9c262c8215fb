"""Encoding texts by segments between safe boundaries, with each distinct segment encoded once per worker for a while.

A boundary is safe if the library never makes a token across it and neither side changes the other. Then the tokens of a
text are those of its segments in turn, long texts never reach the library whole, and frequent words are encoded once.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm import memory

#: Bytes that remembered segments take in each of two generations, and what one takes besides its own bytes.
REMEMBERED_BYTES, ENTRY_BYTES = 96 << 20, 200
#: Longer segments are encoded each time, so that memory does not follow the longest.
LONG_SEGMENT = 256
#: Bytes of distinct segments given to the library at a time.
BATCH_BYTES = 1 << 20
#: Ids put together at a time; one longer segment comes alone.
PIECE_IDS = 1 << 17

#: Segments that begin with their white space, and words alone. White space here: the six ASCII characters.
SPACE_LED = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
#: Segments whose words are plain to see: a space or none, Latin letters, punctuation and symbols that begin no word.
PLAIN = re.compile(r"( ?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?#*$%&]*)")
#: White space to regular expressions, but not to the patterns above; a boundary that touches it is not taken for safe.
OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class Remembered:
    """Results by segment: ``encode`` takes distinct segments as str and returns a result for each.

    When the young generation is full it becomes the old one, so segments that keep coming are not encoded again. Results
    are lengths or packed ids.
    """

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.young, self.old, self.bytes = {}, {}, 0

    def of(self, segments: list[list[bytes]]) -> dict[bytes, object]:
        """A mapping that has the result of every given segment."""
        asked = list({s for text in segments for s in text})
        return dict(zip(asked, self.each(asked), strict=True))

    def each(self, asked: list[bytes]) -> list:
        """The results of distinct segments, in their order."""
        if self.bytes > REMEMBERED_BYTES:
            self.young, self.old, self.bytes = {}, self.young, 0
        young, new = self.young, []
        results = list(map(young.get, asked))
        missing = [i for i, found in enumerate(results) if found is None]
        for i, found in zip(missing, [self.old.get(asked[i]) for i in missing], strict=True):
            if found is None:
                new.append(i)
            else:
                young[asked[i]] = results[i] = found
                self.bytes += ENTRY_BYTES + len(asked[i])
        at = 0
        for batch in batches([asked[i] for i in new]):
            encoded = self.encode([s.decode() for s in batch])
            for i, s, found in zip(new[at : at + len(batch)], batch, encoded, strict=True):
                results[i] = found
                if len(s) <= LONG_SEGMENT:
                    young[s] = found
                    self.bytes += ENTRY_BYTES + len(s) + (len(found) if isinstance(found, bytes) else 0)
            at += len(batch)
        return results


@lru_cache(maxsize=1)
def _byte_table() -> list[str]:
    """Byte-level tokenizers write a visible Latin-1 byte as itself, the others as the characters from 256 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def byte_characters(text: str) -> str:
    table = _byte_table()
    return "".join([table[b] for b in text.encode()])


def batches(segments: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of segments of about BATCH_BYTES; a longer segment comes alone."""
    batch, size = [], 0
    for s in segments:
        if batch and size + len(s) > BATCH_BYTES:
            yield batch
            batch, size = [], 0
        batch.append(s)
        size += len(s)
    if batch:
        yield batch


def cut_rule(description: dict) -> str:
    """How texts may be cut for a tokenizer: "spaces" before white space, "words" at white space, "none" not at all.

    Byte-level pre-tokenizers match white space only in front of or apart from what follows it, so a boundary before
    ASCII white space behind a visible character is safe. A pre-tokenizer that keeps only patterns without white space
    drops it, and a normaliser that composes, lower-cases or merges white space works on single characters or within
    words. Any other description is not cut.
    """
    if any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in description["added_tokens"]):
        return "none"
    model, before, norm = description["model"], description.get("pre_tokenizer") or {}, description.get("normalizer")
    if model["type"] != "BPE" or model.get("dropout") or description.get("truncation") or description.get("padding"):
        return "none"
    if norm is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
        return "spaces"
    steps = before.get("pretokenizers") or []
    local = norm is None or norm.get("type") == "Sequence" and all(
        n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
        for n in norm["normalizers"]
    )
    drops = [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    if local and drops and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and " " not in steps[0]["pattern"].get("Regex", " "):
        return "words"
    return "none"


def joined_beside(segments: list[bytes], unsafe: re.Pattern) -> list[bytes]:
    """The segments without the boundaries that have an unsafe character on either side; all others stay.

    A segment begins with its ASCII white space, so a character is beside a boundary if it ends a segment or follows the
    white space that begins one.
    """
    out: list[list[bytes]] = []
    glued = False
    for segment in segments:
        found = [m.span() for m in unsafe.finditer(segment)]
        led = len(segment) - len(segment.lstrip(b" \t\n\v\f\r"))
        if out and (glued or any(a == led for a, _ in found)):
            out[-1].append(segment)
        else:
            out.append([segment])
        glued = any(b == len(segment) for _, b in found)
    return [b"".join(parts) for parts in out]


def _bytes_of(values: pa.Array) -> list[bytes]:
    """The values of a string or binary array without nulls; several times faster than a scalar for each."""
    _, offsets, data = values.buffers()
    if data is None:
        return [b""] * len(values)
    edges = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    raw, edges = memoryview(data)[edges[0] : edges[-1]].tobytes(), (edges - edges[0]).tolist()
    return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]


class Tokens:
    """A tokenizer of the tokenizers library; without begin, end or other added tokens, truncation or padding."""

    def __init__(self, path: str, result: Callable):
        from tokenizers import Tokenizer

        self.owner = path
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.rule = cut_rule(description)
        steps = (description.get("normalizer") or {}).get("normalizers", [])
        self.lowers = self.rule == "words" and any(n["type"] == "Lowercase" for n in steps)
        self.special = re.compile(b"|".join(re.escape(t["content"].encode()) for t in description["added_tokens"]) or b"$^", re.I)
        self.result = result
        self.marks = lru_cache(maxsize=1024)(lambda marks: result([t.id for t in self.library.model.tokenize(marks)]))
        self.remembered = Remembered(self._encode)

    def _encode(self, texts: list[str]) -> list:
        """Segments of plain letters go to the library's model at once, others through the whole library."""
        tokenize = self.library.model.tokenize
        found: list = [self._plain(t, tokenize) for t in texts]
        rest = [i for i, ids in enumerate(found) if ids is None]
        encodings = self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        for i, encoding in zip(rest, encodings, strict=True):
            found[i] = self.result(encoding.ids)
        return found

    def _plain(self, text: str, tokenize: Callable):
        """The result of letters with punctuation behind them, which a cut tokenizer takes as two words; None for others.

        Letters that are lower-case and composed pass its normaliser as they are, and its pre-tokenizer only writes their
        bytes as characters. Letters that are remembered without what stands around them are not tokenised again.
        """
        match = PLAIN.fullmatch(text)
        if match is None or self.rule == "none":
            return None
        space, word, marks = match.groups()
        if self.rule == "words" and (space or not text.islower() or not (text.isascii() or unicodedata.is_normalized("NFC", text))):
            return None
        found = None
        if marks:
            known = (space + word).encode()
            found = self.remembered.young.get(known)
            if found is None:
                found = self.remembered.old.get(known)
        if found is None:
            characters = word if word.isascii() else byte_characters(word)
            found = self.result([t.id for t in tokenize(byte_characters(space) + characters if space else characters)])
        return found + self.marks(marks) if marks else found

    def cut(self, text: bytes) -> list[bytes]:
        if self.rule == "words":
            return self._lowered(text).split()
        if self.rule == "spaces":
            return joined_beside(SPACE_LED.findall(text), OTHER_SPACE) if OTHER_SPACE.search(text) else SPACE_LED.findall(text)
        return [text] if text else []

    def _lowered(self, text: bytes) -> bytes:
        """The tokenizer lowers letters itself, behind special strings; lowering first makes fewer distinct segments."""
        return text.lower() if self.lowers and not self.special.search(text) else text

    def _numbered(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct segments of the texts, the number of each segment in turn, and how many a text has."""
        if self.rule == "words":
            cut = pc.ascii_split_whitespace(pa.array([self._lowered(t) for t in texts], pa.string()))
            flat, lengths = cut.flatten(), cut.value_lengths().to_numpy()
        else:
            lists = [self.cut(t) for t in texts]
            flat, lengths = pa.array([s for segments in lists for s in segments], pa.binary()), np.array([len(x) for x in lists], np.int64)
        numbers = flat.dictionary_encode()
        return _bytes_of(numbers.dictionary), numbers.indices.to_numpy(), lengths

    def joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and how many each text has, where results are packed ids.

        Python sees the distinct segments of the texts only; their ids are put in place by numpy, in pieces.
        """
        memory.keep(self.owner, self.remembered.forget)
        segments, numbers, lengths = self._numbered(texts)
        packed = self.remembered.each(segments)
        ids = np.frombuffer(b"".join(packed), np.int32)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // ids.itemsize
        starts = np.cumsum(sizes) - sizes
        ends = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(sizes[numbers], out=ends[1:])
        pieces, at = [np.zeros(0, np.int32)], 0
        while at < len(numbers):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE_IDS, side="right")) - 1)
            some = numbers[at:stop]
            pieces.append(ids[np.repeat(starts[some] - ends[at:stop], sizes[some]) + np.arange(ends[at], ends[stop])])
            at = stop
        edges = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths, out=edges[1:])
        return np.concatenate(pieces), np.diff(ends[edges])

    def __call__(self, texts: list[bytes]) -> list[list]:
        """For every text, the results of its segments in turn."""
        memory.keep(self.owner, self.remembered.forget)
        cut = [self.cut(t) for t in texts]
        found = self.remembered.of(cut)
        return [[found[s] for s in segments] for segments in cut]


@lru_cache(maxsize=4)
def counting(path: str) -> Tokens:
    return Tokens(path, len)


@lru_cache(maxsize=4)
def identifying(path: str) -> Tokens:
    return Tokens(path, lambda ids: array("i", ids).tobytes())
