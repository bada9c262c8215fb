"""Token counts, SentencePiece and token files against the libraries on whole texts."""

from __future__ import annotations

import random
import zlib

import llm_cases as cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import memory, segments
from tidemark.llm.pieces import Normaliser, decode_pieces, encode_pieces, pieces
from tidemark.llm.segments import Remembered, counting, cut_rule, identifying
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_files import read_token_files, with_crc32, write_token_files

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ATOMS = [
    "a", "the", "The", "WORD", "end.", "so,", "what?!", "...", "Zürich", "où,", "éa\u0301", "große.", "ñandú", "ǅ", "ª", "²", "tion", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\u0085", "\x1c", "▁", "é", "é", "́",
    "日本", "😀", "ﬁ", "Σ", "İ", "'s", "'LL", "123", "!!", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "</s>", "<unk>", "<0x0A>", "\x00",
]


def mixtures(n=3000, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices(ATOMS, k=rng.randrange(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path, rule", [(BYTES, "spaces"), (WORDS, "words")])
def test_segments_make_the_tokens_of_the_whole(path, rule):
    own, library = identifying(path), Tokenizer.from_file(path)
    assert own.rule == rule
    texts = mixtures()
    for text, packed in zip(texts, own([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(b"".join(packed), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_joined_ids_are_those_of_the_whole_texts(path, monkeypatch):
    """Distinct segments only reach Python; ids are put in place in pieces, also smaller than a segment's."""
    own, library = identifying(path), Tokenizer.from_file(path)
    texts = ["", " ", *mixtures(), "stem stem, stem. Stem,, été été, été&& so$$$ so *** a" + "b" * 400 + "!! " * 50, "x" * 5000, ""]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for piece in (1 << 17, 7):
        monkeypatch.setattr(segments, "PIECE_IDS", piece)
        for first in (0, len(texts) - 3, len(texts) - 1, len(texts)):
            ids, sizes = own.joined([t.encode() for t in texts[first:]])
            assert sizes.tolist() == [len(x) for x in expected[first:]]
            assert ids.dtype == np.int32 and ids.tolist() == [i for x in expected[first:] for i in x]


def test_letters_are_not_tokenised_again_for_what_follows_them():
    own = identifying(WORDS)
    own.remembered.forget()
    alone = own([b"qwzuv"])
    asked_for = []

    class Model:
        def tokenize(self, word):
            asked_for.append(word)
            return Tokenizer.from_file(WORDS).model.tokenize(word)

    found = [own._plain(t, Model().tokenize) for t in ("qwzuv,", "qwzuv;:", "qwzux.")]
    assert asked_for == ["qwzux"] and found[0][: len(alone[0][0])] == alone[0][0]


def test_unknown_descriptions_are_not_cut():
    base = {"added_tokens": [], "model": {"type": "BPE"}, "normalizer": None}
    assert cut_rule(base | {"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}}) == "spaces"
    assert cut_rule(base | {"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": True}}) == "none"
    assert cut_rule(base | {"pre_tokenizer": {"type": "Whitespace"}}) == "none"
    assert cut_rule(base | {"model": {"type": "Unigram"}, "pre_tokenizer": None}) == "none"
    odd = {"content": "<a b>", "lstrip": False, "rstrip": False, "single_word": False}
    assert cut_rule(base | {"added_tokens": [odd], "pre_tokenizer": {"type": "ByteLevel", "use_regex": True}}) == "none"


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(segments, "REMEMBERED_BYTES", 6 * segments.ENTRY_BYTES)
    asked_for = []
    own = Remembered(lambda texts: asked_for.extend(texts) or [len(t) for t in texts])
    for i in range(30):
        asked = [[b"often"], [b"%d" % j for j in range(i, i + 4)], [b"x" * 300]]
        found = own.of(asked)
        assert all(found[s] == len(s) for text in asked for s in text)
        assert len(own.young) <= 11 and len(own.old) <= 11 and b"x" * 300 not in own.young
    assert asked_for.count("often") == 1 and asked_for.count("x" * 300) == 30


def test_packed_results_count_with_their_bytes():
    own = identifying(WORDS)
    own.remembered.forget()
    own([b"some words and others"])
    assert own.remembered.bytes > 4 * segments.ENTRY_BYTES
    memory.begin(WORDS)
    assert own.remembered.young  # its own tasks go on with it
    memory.begin("other")
    assert not own.remembered.young and not own.remembered.old and own.remembered.bytes == 0


@pytest.mark.parametrize("odd", ["\u00a0", "▁", "\x1c", "\u3000"])
def test_one_odd_space_leaves_the_other_boundaries(odd):
    text = " ".join(f"word{i}" for i in range(5000)) + odd + " " + odd + " ".join(f"more{i}" for i in range(5000))
    cut = identifying(BYTES).cut(text.encode())
    assert b"".join(cut) == text.encode() and len(cut) > 9_900
    assert len(pieces(PIECES).cut(text.encode())) > 9_900


def test_counts(spark):
    counted = token_counts(cases.documents(spark), BYTES)
    assert set(counted.columns) >= set(cases.CLASHING)
    library = Tokenizer.from_file(BYTES)
    expected = [
        (d, t, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in cases.rows()
    ]
    found = counted.select("doc_id", "text", "n_bytes", "n_tokens").collect()
    assert cases.bag(map(tuple, found)) == cases.bag(expected)
    assert token_counts(cases.nothing(spark), BYTES).collect() == []
    assert counting(BYTES)([b"one <|endoftext|>"]) == [[1, 2]]


def test_pieces(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = encode_pieces(cases.documents(spark), PIECES)
    assert set(encoded.columns) >= set(cases.CLASHING)
    found = encoded.select("doc_id", "text", "piece_ids", "decoded").collect()
    expected = []
    for d, t, *_ in cases.rows():
        ids = library.encode(t or "")
        expected.append((d, t, ids, library.decode(ids)))
    assert cases.bag(map(tuple, found)) == cases.bag(expected)
    again = decode_pieces(encoded.select("doc_id", "piece_ids", "decoded"), PIECES, out="again")
    assert again.where(F.col("again") != F.col("decoded")).count() == 0
    assert encode_pieces(cases.nothing(spark), PIECES).collect() == []


def test_piece_offsets_cover_the_source():
    own, library = pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t.encode() for t in mixtures()]
    for text, ids in zip(texts, own.ids(texts), strict=True):
        assert ids.tolist() == library.encode(text.decode())
        edges = own.offsets(text, ids).tolist()
        assert edges[0] == 0 and edges[-1] == len(text) and edges == sorted(edges)
        for i, a, b in zip(ids.tolist(), edges, edges[1:], strict=False):
            if not library.is_byte(i) and not (a == 0 and library.id_to_piece(i).startswith("▁")):
                assert text[a:b].decode().replace(" ", "▁") == library.id_to_piece(i)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_follows_the_compiled_map(rule):
    """Against the library's own normaliser, with its compiled maps."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    spec = model.normalizer_spec
    for prefix in (True, False):
        for squeeze in (True, False):
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = prefix, squeeze, True
            theirs, own = sentencepiece.SentencePieceProcessor(), Normaliser(spec, [])
            theirs = sentencepiece.SentencePieceNormalizer(model_proto=model.SerializeToString())
            for text in [*mixtures(400), "①㌔ﾊﾞｶ ﬁ", "  lead and trail  ", "ＡＢＣ　ｄ", ""]:
                normal, source = own(text.encode())
                assert normal.decode() == theirs.normalize(text)
                assert len(source) == len(normal) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


def test_token_files(spark, tmp_path):
    docs = cases.documents(spark)
    path = str(tmp_path / "ids")
    write_token_files(docs, path, WORDS)
    library, start, expected = Tokenizer.from_file(WORDS), 0, []
    stored = read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in stored[2:]] == sorted(r.doc_id for r in stored[2:]) and stored[0].doc_id is stored[1].doc_id is None
    for r in stored:
        assert r.start == start and r.n_tokens == len(r.token_ids) and r.token_ids[-1] == 1
        start += r.n_tokens
        expected.append((r.doc_id, r.start, r.n_tokens, zlib.crc32(np.array(r.token_ids, "<u4").tobytes())))
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, *_ in cases.rows()]
    assert cases.bag((r.doc_id, r.token_ids) for r in stored) == cases.bag(ids)
    assert cases.bag(map(tuple, with_crc32(read_token_files(spark, path)).collect())) == cases.bag(expected)


def test_token_files_prune_by_id(spark, tmp_path):
    docs = spark.range(5000).selectExpr("id * 2 AS doc_id", "concat('text ', id) AS text")
    path = str(tmp_path / "ids")
    write_token_files(docs, path, WORDS)
    found = read_token_files(spark, path).where("doc_id = 4242")
    assert "EqualTo(doc_id,4242)" in found._jdf.queryExecution().toString()
    assert [r.doc_id for r in found.collect()] == [4242] and found.first().start > 0
    import pyarrow.orc as orc

    files = sorted(p for p in (tmp_path / "ids").iterdir() if p.suffix == ".orc")
    assert sum(orc.ORCFile(f).nrows for f in files) == 5000
    write_token_files(docs.limit(0), str(tmp_path / "none"), WORDS)
    assert read_token_files(spark, str(tmp_path / "none")).collect() == []
