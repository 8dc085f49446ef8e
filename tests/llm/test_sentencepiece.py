from __future__ import annotations

import struct

import pytest
import sentencepiece
from helpers import DOCS, LONG, ODD, SMALL, odd_docs, table
from hypothesis import given, settings
from hypothesis import strategies as st

from wardbook.llm import queries
from wardbook.llm.sentencepiece_tokens import BPE, BYTE, CONTROL, MARKER, UNIGRAM, UNKNOWN, Codec, cutter, load, parse, tokenize

with open(queries.MODEL_PATH, "rb") as file:
    MERGES = file.read()


def number(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def part(tag: int, content: bytes) -> bytes:
    return number(tag << 3 | 2) + number(len(content)) + content


def unigram_model(words: dict[str, float], trim: bool, byte_fallback: bool = True) -> bytes:
    """A model file with given pieces and scores; nothing is trained."""
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", -20.0, BYTE) for b in range(256)]
    pieces += [(w, s, 1) for w, s in words.items()]
    body = b"".join(part(1, part(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + number(k)) for p, s, k in pieces)
    trainer = b"\x18" + number(UNIGRAM) + number(35 << 3) + number(int(byte_fallback))
    normalizer = b"\x18\x01" + b"\x20" + number(int(trim)) + b"\x28\x01"
    return body + part(2, trainer) + part(3, normalizer)


WORDS = {MARKER: -3.0, f"{MARKER}the": -2.1, "the": -4.3, f"{MARKER}t": -5.7, "he": -4.9, "t": -6.1, "h": -6.3, "e": -5.2, f"{MARKER}cat": -7.4, "c": -6.6, "a": -5.9, "at": -5.05, "s": -5.3, f"{MARKER}{MARKER}": -3.7}
TEXTS = ["", " ", "  ", "the cat", "the  cats ", " the", "thethe", "zebra é 日本 😀", "a\nb\tc", f"{MARKER}x {MARKER}", "<s> </s> <unk>", "t" * 300, "\x00\x01"]


@pytest.mark.parametrize("trim", [False, True])
def test_unigram_parity(trim):
    data = unigram_model(WORDS, trim)
    model = parse(data)
    assert (model.kind, model.byte_fallback, model.trim, model.dummy_prefix) == (UNIGRAM, True, trim, True)
    codec = Codec(data, threads=2)
    ids, back, same = codec.encode(TEXTS)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [i.tolist() for i in ids] == reference.encode(TEXTS)
    assert all(same)
    assert back == [codec.plain(codec.normal(t)) for t in TEXTS]


def test_literal_byte_pieces_are_no_bytes():
    """A text that spells a byte's piece is no such byte: the rebuilt tokenizer agrees by itself."""
    codec = Codec(unigram_model(WORDS, False))
    texts = ["<0x0A>", "the", "the<0x0A>cat", "<<0xE4>>", "x <0x0A> y", "<0x0a>", "<0x0A", "<0x0A><0x0B>", "\n"]
    ids, back, same = codec.encode(texts)
    assert all(same) and [i.tolist() for i in ids] == codec.check.encode(texts)
    assert back == [codec.plain(codec.normal(t)) for t in texts]


def test_a_piece_that_crosses_markers_forbids_cutting():
    assert cutter(parse(unigram_model(WORDS, False))) is not None
    assert cutter(parse(unigram_model({**WORDS, f"a{MARKER}t": -1.0}, False))) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=4))
def test_merge_parity_and_round_trip(texts):
    codec = CODECS
    ids, back, same = codec.encode(texts)
    assert [i.tolist() for i in ids] == codec.check.encode(texts)
    assert all(same)
    assert back == texts if not any(MARKER in t for t in texts) else True
    assert codec.decode([i.tolist() for i in ids]) == back


CODECS = Codec(MERGES, threads=1)


def test_the_model_file_is_read_whole():
    model = parse(MERGES)
    assert model.kind == BPE
    reference = CODECS.check
    assert [p for p, _, _ in model.pieces] == [reference.id_to_piece(i) for i in range(reference.get_piece_size())]
    assert [s for _, s, _ in model.pieces] == [reference.get_score(i) for i in range(reference.get_piece_size())]


def test_a_difference_is_told_and_the_rebuilt_tokenizer_s_ids_stay():
    codec = Codec(MERGES, threads=1)
    codec.joiner = codec.bare = Codec(unigram_model(WORDS, False), verify=False).bare
    ids, _, same = codec.encode(["the cat"])
    assert same == [False]
    assert ids[0].tolist() == codec.bare.encode("▁the▁cat", add_special_tokens=False).ids != codec.check.encode("the cat")


def test_query_has_the_library_s_ids(spark):
    rows = dict(table("documents", "doc_id, text"))
    found = queries.op2_sentencepiece(spark, SMALL).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.ids == CODECS.check.encode(rows[r.doc_id])
        assert r.round_trip and r.parity and r.n_tokens == len(r.ids)


def test_odd_rows(spark):
    more = [(3000, LONG, "en", "a", 1)]
    docs = odd_docs(spark, more)
    found = tokenize(docs, load(docs, queries.MODEL_PATH)).collect()
    assert len(found) == len(ODD) + 1
    texts = sorted((str(r[0]), r[1] or "") for r in [*ODD, *more])
    assert sorted((str(r.doc_id), r.decoded or "") for r in found) == texts
    null = next(r for r in found if r.doc_id == 1)
    assert (null.ids, null.n_tokens, null.decoded, null.round_trip, null.parity) == (None, 0, None, None, None)
    assert next(r for r in found if r.doc_id == 2).ids == []
    assert tokenize(spark.createDataFrame([], DOCS), MERGES).count() == 0


def test_a_missing_model_is_an_error(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    with pytest.raises(ValueError, match="one model file"):
        load(spark.range(1), str(tmp_path / "folder"))
