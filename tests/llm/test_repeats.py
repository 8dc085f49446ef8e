from __future__ import annotations

import hashlib
import random

import brute
import pytest
from helpers import DOCS, ODD, SMALL, odd_docs, ordered, table
from hypothesis import given, settings
from hypothesis import strategies as st

from wardbook.llm import queries
from wardbook.llm.repeats import remove_repeats, repeated_words
from wardbook.llm.suffix_index import Anchors, IndexFamily, Words, entry, merged, runs


def test_query_equals_brute_force(spark):
    rows = table("documents", "doc_id, text")
    texts = [t for _, t in rows]
    want = ordered((d, *w, n) for (d, _), w, n in zip(rows, brute.repeats(texts, 400), brute.repeated_words(texts, 51), strict=True))
    assert ordered(queries.op5_suffix_dedup(spark, SMALL).collect()) == want
    assert sum(w[2] for w in want) > 0


def passages(seed: int) -> list[str]:
    """Texts that share passages of lengths about the limit, at many places; also periodic ones."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("abcdefgh ", k=n)) for n in (10, 18, 19, 20, 21, 25, 40, 90)]
    texts = ["".join(rng.choice(pieces) if rng.random() < 0.6 else "".join(rng.choices("ijklm ", k=rng.randint(1, 30))) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    return [*texts, "x" * 19, "x" * 20, "x" * 21, "ab" * 40, "ä" * 30, texts[0], texts[0]]


@pytest.mark.parametrize(("hot", "batch"), [(50_000, 2_000), (50_000, 3), (1, 2_000)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_on_shared_passages(spark, hot, batch, seed):
    texts = passages(seed)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = remove_repeats(docs, length=20, anchor=6, hot_stretches=hot, batch_entries=batch, large_group=hot)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
    assert ordered(got) == ordered((i, *w) for i, w in enumerate(brute.repeats(texts, 20)))


@pytest.mark.parametrize(("hot", "batch"), [(50_000, 2_000), (3, 2), (1, 1)])
def test_a_hot_anchor_is_split(spark, hot, batch):
    """Many different texts round one passage: by sides of the anchor, and by windows where a side is shared by many too."""
    rng = random.Random(9)
    core, beside = "K" * 6 + "abcdef", "ghijklmn"
    texts = []
    for _ in range(80):
        left, right = ("".join(rng.choices("pqrs", k=rng.randint(0, 16))) for _ in range(2))
        texts.append(left + rng.choice(("", beside)) + core + rng.choice(("", beside, beside[:4])) + right)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = remove_repeats(docs, length=20, anchor=6, hot_stretches=hot, batch_entries=batch, large_group=hot)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
    assert ordered(got) == ordered((i, *w) for i, w in enumerate(brute.repeats(texts, 20)))


def planted() -> tuple[list[str], dict[int, tuple[int, int]], set[int]]:
    """Texts, (bytes, words) of the passage planted in each text of a pair or group, and the clean ones."""
    rng = random.Random(11)

    def prose(n: int) -> str:
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))

    texts, where = [], {}
    for n in [*range(48, 56), 60, 66, 72, 80, 100] * 3:
        passage = prose(n)
        for _ in range(rng.choice((2, 2, 3, 40))):
            where[len(texts)] = (len(passage.encode()), n)
            texts.append(f"{prose(rng.randint(5, 60))}#{len(texts)}\n\n{passage}\n\n@{len(texts)} {prose(rng.randint(5, 60))}")
    clean = set(range(len(texts), len(texts) + 60))
    return [*texts, *(prose(rng.randint(1, 300)) for _ in clean)], where, clean


@pytest.mark.parametrize("hot", [1_000, 10])
def test_planted_passages_on_both_sides_of_the_limits(spark, hot):
    """All of 400 bytes and all of 51 words are caught, shorter ones and clean texts are left alone."""
    texts, where, clean = planted()
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    removed = {r.doc_id: r.n_removed for r in remove_repeats(docs, hot_stretches=hot).collect()}
    worded = {r.doc_id: r.n_repeated_words for r in repeated_words(docs, hot_stretches=hot).collect()}
    assert {size >= 400 for size, _ in where.values()} == {words >= 51 for _, words in where.values()} == {True, False}
    for i, (size, words) in where.items():
        # A copy agrees on the blank lines beside the passage as well, and on what follows by chance.
        assert removed[i] >= size if size >= 400 else removed[i] in (0, *range(400, 410)), (i, size)
        assert worded.get(i, 0) >= words if words >= 51 else i not in worded
    assert all(not removed[i] and i not in worded for i in clean)
    assert [worded.get(i, 0) for i in range(len(texts))] == brute.repeated_words(texts, 51)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=120), min_size=1, max_size=12), st.integers(1, 4), st.integers(0, 40))
def test_the_family_finds_what_comparing_finds(texts, batch, pairs):
    """Every window that stands twice is found, by pairs and by classes, whatever the batches."""
    length, raw = 12, [t.encode() for t in texts]
    cut = Anchors(length, 5, piece=64)
    family = IndexFamily(length)
    family.PAIRS = pairs
    entries = []
    for i, text in enumerate(raw):
        for first, windows, place, h in cut.stretches(text):
            entries.append(entry(h, (i, first), 1, place - first, windows, text[first : first + windows + length - 1]))
    for at in range(0, len(entries), batch):
        family.add(entries[at : at + batch])
    found = {(e.key[0], e.key[1] + t) for e in family.repeats() for a, b in [runs(e.found)[k : k + 2] for k in range(0, len(runs(e.found)), 2)] for t in range(a, b)}
    windows = [(i, s, t[s : s + length]) for i, t in enumerate(raw) for s in range(len(t) - length + 1)]
    seen = [w for _, _, w in windows]
    assert found == {(i, s) for i, s, w in windows if seen.count(w) > 1}
    sizes = [len(level.entries) for level in family.levels]
    assert all(a.bit_length() > b.bit_length() for a, b in zip(sizes, sizes[1:], strict=False))


def test_stretches_cover_every_window_once_and_depend_on_content():
    rng = random.Random(0)
    shared = bytes(rng.choices(range(256), k=3000))
    cut = Anchors()
    anchors = []
    for before in (0, 777, 300_000):
        text = bytes(rng.choices(range(256), k=before)) + shared
        found = list(cut.stretches(text))
        assert [f for f, _, _, _ in found][1:] == [f + n for f, n, _, _ in found][:-1]
        assert found[0][0] == 0 and found[-1][0] + found[-1][1] == len(text) - 399
        anchors.append({(p - before, h) for _, _, p, h in found if p >= before + 400})
    assert anchors[0] == anchors[1] == anchors[2]
    assert list(cut.stretches(b"x" * 399)) == []


def test_odd_rows(spark):
    long = "lorem ipsum " * 30_000
    more = [(50, long, "en", "a", 1), (51, "y" * 500, "en", "a", 1), (10, "z" + "y" * 500, "en", "a", 1)]
    docs = odd_docs(spark, more)
    rows = [(r[0], r[1]) for r in [*ODD, *more]]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(docs, length=40, anchor=16).collect()]
    assert ordered(got) == ordered((d, *w[:3]) for (d, _), w in zip(rows, brute.repeats([t for _, t in rows], 40), strict=True))
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    found = {(r.doc_id, r.hash): r.n_repeated_words for r in repeated_words(docs, words=4, anchor=2).collect()}
    have = ordered((d, n) for (d, _), n in zip(rows, brute.repeated_words([t for _, t in rows], 4), strict=True) if n)
    assert ordered({(d, n) for (d, _), n in found.items()}) == ordered(set(have))
    assert repeated_words(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
def test_words_are_coded_alike_wherever_they_stand(piece):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab\x00ä \t\n\v\x1c\u00a0", k=rng.randint(0, 60))) for _ in range(200)]
    codes: dict[str, bytes] = {}
    for text in texts:
        found = Words(piece).codes(text.encode())
        want = brute.words(text)
        assert len(found) == 4 * len(want)
        for i, word in enumerate(want):
            assert codes.setdefault(word, found[4 * i : 4 * i + 4]) == found[4 * i : 4 * i + 4]
    assert len(set(codes.values())) == len(codes)


def test_runs_and_merging():
    assert runs(0b1101110) == [1, 4, 5, 7]
    assert runs(0) == []
    assert merged([(5, 9), (1, 3), (3, 5), (20, 21)]) == [(1, 9), (20, 21)]
