"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the model's own rules: at each position the longest prefix that the compiled character map knows
is replaced, any other character stays, and every normalised byte records the source byte it comes from. The pieces of
the library cover the normalised bytes in turn, so projecting their ends through that record gives each piece's bytes in
the source. Byte pieces cover one byte.

Where the map is empty and no piece holds a space mark behind another character, a text is encoded in segments between
spaces: merges never cross such a boundary, and the mark that begins a segment is the one the library itself puts first.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import memory
from tidemark.llm.rows import with_text_columns
from tidemark.llm.segments import Remembered

MARK = "▁".encode()
SPACE_LED = re.compile(rb" *[^ ]+| +$")
ADDED = T.StructType(
    [
        T.StructField("piece_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("piece_offsets", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ]
)


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8, then replacement strings that end with a zero byte.

    A unit of the trie holds a label in its low byte (with bit 31), a leaf mark in bit 8 and an offset to its children
    in the bits from 10, shifted by 8 more where bit 9 is set; the unit at a leaf's offset holds the value.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of text[at:]."""
        if not self.units:
            return None
        units, node, found = self.units, self._children(self.units[0]), None
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= self._children(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


def character_bytes(text: bytes, at: int) -> int:
    lead = text[at]
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normaliser:
    """Normalised bytes of a text and the source offset of each, with the end of the text as a last entry."""

    def __init__(self, spec, keep: list[str]):
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.keep = sorted((k.encode() for k in keep), key=len, reverse=True)

    @property
    def plain(self) -> bool:
        """Only spaces become marks, one for one, behind a first mark."""
        return self.map is None and not self.keep and self.prefix and self.escape and not self.squeeze

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if self.plain:
            return self._plain(text)
        pieces, at = [], 0
        while at < len(text):
            size, new = self._step(text, at)
            pieces.append((at, new))
            at += size
        stop = len(text)
        if self.squeeze:
            while pieces and pieces[0][1] in (b" ", b""):
                pieces.pop(0)
        if not pieces:
            return b"", np.array([stop], np.int64)
        mark = MARK if self.escape else b" "
        out, source = bytearray(), []
        if self.prefix:
            out += mark
            source += [pieces[0][0]] * len(mark)
        open_space = self.squeeze and self.prefix
        for place, new in pieces:
            if self.squeeze and open_space:
                new = new.lstrip(b" ")
            if not new:
                continue
            if self.squeeze:
                open_space = new.endswith(b" ")
            new = new.replace(b" ", mark)
            out += new
            source += [place] * len(new)
        if self.squeeze:
            while out.endswith(mark):
                stop = source[-len(mark)]
                del out[-len(mark) :], source[-len(mark) :]
        return bytes(out), np.array([*source, stop], np.int64)

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.keep:
            if text.startswith(symbol, at):
                return len(symbol), symbol
        found = self.map.longest(text, at) if self.map else None
        if found:
            return found
        size = character_bytes(text, at)
        return size, text[at : at + size]

    @staticmethod
    def _plain(text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        widths = np.where(np.frombuffer(text, np.uint8) == 32, len(MARK), 1)
        source = np.repeat(np.arange(len(text)), widths)
        return MARK + text.replace(b" ", MARK), np.r_[np.zeros(len(MARK), np.int64), source, len(text)]


class Pieces:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        own = [p.piece for p in model.pieces if p.type == kinds.USER_DEFINED]
        self.normalise = Normaliser(model.normalizer_spec, own)
        self.widths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = self.library.unk_id()
        mark = MARK.decode()
        self.mark_id = self.library.piece_to_id(mark)
        bpe = model.trainer_spec.model_type == model.trainer_spec.BPE and not model.trainer_spec.treat_whitespace_as_suffix
        inside = any(mark in p.piece.lstrip(mark) for p in model.pieces)
        self.separable = bpe and self.normalise.plain and not inside and self.mark_id != self.unknown and not any(p.type == kinds.UNUSED for p in model.pieces)
        self.owner, self.remembered = path, Remembered(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Ids of segments, packed; the library puts a mark in front, so the empty segment is the mark alone."""
        found = self.library.encode(texts, num_threads=1)
        return [np.array(ids if text else [self.mark_id], np.int32).tobytes() for text, ids in zip(texts, found, strict=True)]

    def cut(self, text: bytes) -> list[bytes] | None:
        """Segments without their first mark; None if the text has to be encoded whole. A mark in a text is a space."""
        if not self.separable:
            return None
        if not text:
            return []
        text = text.replace(MARK, b" ")
        segments = text.split(b" ")
        if b"" in segments:
            segments = [s[1:] for s in SPACE_LED.findall(b" " + text)]
        return segments

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        memory.keep(self.owner, self.remembered.forget)
        cut = [self.cut(t) for t in texts]
        found = self.remembered.of([segments for segments in cut if segments])
        whole = iter(self.library.encode([t.decode() for t, c in zip(texts, cut, strict=True) if c is None], num_threads=1))
        return [np.array(next(whole), np.int32) if c is None else np.frombuffer(b"".join([found[s] for s in c]), np.int32) for c in cut]

    def offsets(self, text: bytes, ids: np.ndarray) -> np.ndarray:
        """Source bytes at which the pieces begin, and the end of the last."""
        if not len(ids):
            return np.zeros(1, np.int32)
        normal, source = self.normalise(text)
        widths = self.widths[ids]
        if self.unknown in ids:
            widths = self._unknown_widths(text, ids, widths)
        ends = np.r_[0, np.cumsum(widths)]
        if ends[-1] != len(normal):
            raise ValueError("pieces do not cover the normalised text")
        return source[ends].astype(np.int32)

    def _unknown_widths(self, text: bytes, ids: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """Widths with those of unknown pieces, whose normalised characters the library tells."""
        told = self.library.encode(text.decode(), out_type="immutable_proto").pieces
        return np.where(ids == self.unknown, [len(p.piece.encode()) for p in told], widths)


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def integer_lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode_pieces(docs: DataFrame, model: str, text_column: str = "text") -> DataFrame:
    """The documents with ``piece_ids``, ``piece_offsets`` and ``decoded``.

    Ids are those of the sentencepiece library without begin or end ids and without sampling. ``piece_offsets`` has one
    entry more than ids: piece i covers the UTF-8 bytes of the text from entry i to entry i + 1 (the mark put in front of
    a text covers none). ``decoded`` is what the library decodes the ids to. ``model`` is the path of the model file,
    present on every machine. Null and empty texts: no ids, offsets [0], decoded empty. Repeated rows are encoded each; a
    column named like a result is replaced.
    """

    def compute(texts: list[bytes]) -> list[pa.Array]:
        own = pieces(model)
        ids = own.ids(texts)
        offsets = [own.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
        decoded = [own.library.decode(i.tolist()) if len(i) else "" for i in ids]
        return [integer_lists(ids), integer_lists(offsets), pa.array(decoded, pa.string())]

    return with_text_columns(docs, text_column, ADDED, compute, owner=model)


def decode_pieces(rows: DataFrame, model: str, ids_column: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """The rows with ``out``, the text of their ids; null ids give an empty text."""
    stay = [f for f in rows.schema.fields if f.name != out]
    names = [f.name for f in stay]

    def run(batches):
        for batch in batches:
            ids = batch.column(ids_column).to_pylist()
            texts = pa.array([pieces(model).library.decode(i) if i else "" for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, out])

    return rows.mapInArrow(run, T.StructType([*stay, T.StructField(out, T.StringType())]))
