"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf: its pieces with scores and kinds, the trainer's kind of model, and the normaliser's settings are read
field by field. From them a tokenizer is rebuilt: the character map and the handling of blanks as normalisers, the
metaspace marker, unigram scores (or, for a merge model, the merges in order of the scores of what they make), byte
fallback, and the decoder that turns all of it back. Texts are encoded in batches on `threads` threads per task.

Where no piece has the marker after another character, no piece can reach from a word into the next marker; normalised texts
are then cut there. That changes no result, and each distinct word goes through the library once per worker.

Parity: with `verify`, the sentencepiece library encodes everything that the tokenizers library encodes, and a column says
if a text's ids are equal. The ids returned are those of the rebuilt tokenizer in any case. In a unigram model with byte fallback the
library would take the literal text `<0x0A>` for that byte's piece; such a text is cut behind its `<`, where no ordinary piece reaches.

Defined results. Very long texts: whole. Ties between segmentations: as the tokenizers library breaks them, the parity column tells. Null text: null ids and null text back, 0 tokens. Empty text: no ids. `round_trip` says whether the decoded text
equals the normalised input. Repeated rows: each comes back; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from wardbook.llm.common import map_texts

MARKER = "▁"
# Fixed values of the file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Distinct words that a worker holds with their ids.
MAX_WORDS = 200_000
#: Words that go through the library as one string.
JOINED = 1000

TOKENS = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "decoded": pa.string(), "round_trip": pa.bool_(), "parity": pa.bool_()}


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    character_map: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    def ids(self, kind: int) -> list[int]:
        return [i for i, p in enumerate(self.pieces) if p[2] == kind]


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-size numbers come as their bytes."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
            yield key >> 3, value
            continue
        size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
        yield key >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in _message(data):
        if number == 1:
            piece = dict(_message(value))
            model.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_message(value))
            model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            settings = dict(_message(value))
            model.character_map = settings.get(2, b"")
            model.dummy_prefix, model.trim, model.escape = (bool(settings.get(i, 1)) for i in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"models of kind {model.kind} are not supported")
    return model


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece; better pieces first, among them by the pair's own ids."""
    rank = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for i, (piece, score, kind) in enumerate(pieces):
        if kind == NORMAL:
            pairs = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in rank and piece[k:] in rank]
            found += [(-score, i, rank[a], rank[b], (a, b)) for a, b in pairs]
    return [pair for *_, pair in sorted(found)]


def build(model: Model) -> Tokenizer:
    unknown = model.ids(UNKNOWN)
    if model.kind == UNIGRAM:
        # Control pieces stand for no text; with a blank, which normalised texts do not have, none can match them.
        core = models.Unigram([(f" {p}" if kind in (UNKNOWN, CONTROL) and model.escape else p, s) for p, s, kind in model.pieces], unk_id=unknown[0] if unknown else None, byte_fallback=model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            _merges(model.pieces),
            unk_token=model.pieces[unknown[0]][0] if unknown else None,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    marker = MARKER if model.escape else " "
    steps = [normalizers.Precompiled(model.character_map)] if model.character_map else []
    if model.trim:
        steps += [normalizers.Replace(Regex(f"^ +|[ {MARKER if model.escape else ''}]+$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape:
        steps.append(normalizers.Replace(" ", MARKER))
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(marker))  # leaves an empty text empty
    tokenizer.normalizer = normalizers.Sequence(steps)
    if split := _byte_names_apart(model):
        tokenizer.pre_tokenizer = split
    tokenizer.decoder = decoder(model)
    return tokenizer


def _byte_names_apart(model: Model):
    """Cuts texts that spell a byte's piece, if no ordinary piece reaches across the cut."""
    if model.kind != UNIGRAM or not model.byte_fallback or any("<0" in p for p, _, kind in model.pieces if kind != BYTE):
        return None
    return pre_tokenizers.Split(Regex("<(?=0x[0-9A-F]{2}>)"), "merged_with_previous")


def decoder(model: Model, strip: bool = True):
    undo = [decoders.Replace(MARKER, " ")] if model.escape else []
    undo += [decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix and strip:
        undo.append(decoders.Strip(" ", 1, 0))
    return decoders.Sequence(undo)


def cutter(model: Model) -> re.Pattern | None:
    """Cuts a normalised text before each run of markers, if no piece can reach across such a cut."""
    ordinary = [p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)]
    if not model.escape or any(re.search(f"[^{MARKER}]{MARKER}", p) for p in ordinary):
        return None
    return re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")


class Codec:
    """Batches of texts to ids and back."""

    def __init__(self, data: bytes, threads: int = 2, verify: bool = True):
        # One task has one core or a few; the library's own default is every core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        model = parse(data)
        self.tokenizer = build(model)
        self.tokenizer.encode_special_tokens = True
        self.normalizer = self.tokenizer.normalizer
        self.cutter = cutter(model)
        #: The ids of words, as bytes.
        self.words: dict[str, bytes] = {}
        #: Words whose ids do not decode to themselves, or differ between the libraries: (decoded text, same ids).
        self.odd: dict[str, tuple[str, bool]] = {}
        self.prefixed = model.dummy_prefix
        self.threads, self.check = threads, None
        # A word that was cut from a normalised text is a text of its own only if normalising it again changes nothing.
        self.by_word = bool(self.cutter) and model.escape and model.dummy_prefix and not model.trim and not model.character_map
        if self.cutter:
            self.bare = build(model)
            self.bare.encode_special_tokens = True
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.decoder = decoder(model, strip=False)
            self.joiner = build(model)
            self.joiner.encode_special_tokens = True
            self.joiner.normalizer = normalizers.Sequence([])
            cuts = [pre_tokenizers.Split(Regex(self.cutter.pattern), "isolated"), _byte_names_apart(model)]
            self.joiner.pre_tokenizer = pre_tokenizers.Sequence([c for c in cuts if c])
            self.starts = np.array([p.startswith(MARKER) for p, _, _ in model.pieces])
        if verify:
            import sentencepiece

            self.check = sentencepiece.SentencePieceProcessor(model_proto=data)

    def normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text)

    def plain(self, normal: str) -> str:
        """What the decoder should give back for a normalised text."""
        out = normal.replace(MARKER, " ")
        return out[1:] if self.prefixed and out.startswith(" ") else out

    def encode(self, texts: list[str], normal: list[str] | None = None) -> tuple[list[np.ndarray], list[str], list[bool]]:
        """Per text its ids, what they decode to, and whether both libraries agree; `normal`: the normalised texts."""
        if self.cutter:
            ids, back, same = self._encode_words([self.cutter.findall(n) for n in normal or map(self.normal, texts)])
        else:
            found = self._library(self.tokenizer, texts)
            ids, back, same = [np.array(f, np.int32) for f in found], self.decode(found), [True] * len(texts)
        if self.check is None or self.by_word:
            return ids, back, same
        expected = self.check.encode(texts, num_threads=self.threads)
        return ids, back, [a.tolist() == b for a, b in zip(ids, expected, strict=True)]

    @staticmethod
    def _library(tokenizer: Tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_tokenizers(self, words: list[str]) -> list[bytes]:
        """The ids of words, as bytes. Words with one marker go through the library many at a time: the marker shows
        where each begins in the ids."""
        joined = ["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        out: list[bytes] = []
        for at, ids in zip(range(0, len(words), JOINED), self._library(self.joiner, joined), strict=True):
            raw, part = np.array(ids, np.int32), words[at : at + JOINED]
            starts = np.flatnonzero(self.starts[raw])
            if len(starts) != len(part) or any(w[1:2] == MARKER or w == MARKER for w in part):
                out += [array("i", f).tobytes() for f in self._library(self.bare, part)]
                continue
            data, cuts = raw.tobytes(), (4 * np.append(starts, len(raw))).tolist()
            out += [data[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        return out

    def _by_sentencepiece(self, words: list[str]) -> list[bytes]:
        """The ids of words that start with a marker each, which the library puts there itself."""
        found = self.check.encode([w[1:].replace(MARKER, " ") for w in words], num_threads=self.threads)
        # An empty text gets no marker.
        return [array("i", f).tobytes() if f or w != MARKER else array("i", [self.check.piece_to_id(MARKER)]).tobytes() for f, w in zip(found, words, strict=True)]

    def _learn(self, words: list[str]) -> None:
        """Encode new words by both libraries and decode them again."""
        found = self._by_tokenizers(words)
        expected = self._by_sentencepiece(words) if self.check and self.by_word else found
        self.words.update(zip(words, found, strict=True))
        differ = [w for w, f, e in zip(words, found, expected, strict=True) if f != e]
        self.odd.update((w, (self._text(self.words[w]), False)) for w in differ)
        # Decoded together first; one by one only where that does not give the words themselves.
        if self._text(b"".join(found)) != "".join(words).replace(MARKER, " "):
            for word, ids in zip(words, found, strict=True):
                if (text := self._text(ids)) != word.replace(MARKER, " "):
                    self.odd[word] = text, self.odd.get(word, ("", True))[1]

    def _text(self, ids: bytes) -> str:
        return self.bare.decode(np.frombuffer(ids, np.int32).tolist(), skip_special_tokens=False)

    def _encode_words(self, cut: list[list[str]]) -> tuple[list[np.ndarray], list[str], list[bool]]:
        """Each distinct word is encoded and decoded once and then looked up, until there are too many to hold."""
        if len(self.words) > MAX_WORDS:
            self.words.clear()
            self.odd.clear()
        # Words with several markers stand together, so that few of them are encoded one by one.
        new = sorted({w for words in cut for w in words if w not in self.words}, key=lambda w: w[1:2] == MARKER or len(w) == 1)
        if new:
            self._learn(new)
        ids, back, same = [], [], []
        for words in cut:
            ids.append(np.frombuffer(b"".join([self.words[w] for w in words]), np.int32))
            odd = [w for w in words if w in self.odd] if self.odd else []
            text = "".join([self.odd[w][0] if w in self.odd else w.replace(MARKER, " ") for w in words]) if odd else "".join(words).replace(MARKER, " ")
            back.append(text[1:] if self.prefixed and text.startswith(" ") else text)
            same.append(all(self.odd[w][1] for w in odd))
        return ids, back, same

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@lru_cache(maxsize=1)
def codec(data: bytes, threads: int, verify: bool) -> Codec:
    """Built once per Python worker, not once per task."""
    return Codec(data, threads, verify)


def load(df: DataFrame, model_path: str) -> bytes:
    """The model file, read by Spark from wherever it is, at most 64 MB."""
    rows = df.sparkSession.read.format("binaryFile").load(model_path).filter(F.col("length") <= 64 << 20).select("content").collect()
    if len(rows) != 1:
        raise ValueError(f"{model_path}: one model file of at most 64 MB is needed")
    return bytes(rows[0][0])


def tokenize(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", threads: int = 2, verify: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded, round_trip, parity) for each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 64 MB

    def work():
        coder = codec(shared.value, threads, verify)

        def values(texts):
            plain = [t.decode("utf-8", "replace") for t in texts if t is not None]
            normal = [coder.normal(t) for t in plain]
            ids, back, same = coder.encode(plain, normal)
            there = np.array([t is not None for t in texts], bool)
            n = np.zeros(len(texts), np.int64)
            n[there] = [len(i) for i in ids]
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            listed = pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~there))
            rest = iter(zip(back, (b == coder.plain(n) for b, n in zip(back, normal, strict=True)), same, strict=True))
            rows = [next(rest) if t is not None else (None, None, None) for t in texts]
            return listed, n, *zip(*rows, strict=True)

        return values

    return map_texts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), work, TOKENS, drop_text=True, rows=128)
