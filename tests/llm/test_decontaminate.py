from __future__ import annotations

import hashlib
import random

import brute
import pytest
from helpers import DOCS, LONG, ODD, SMALL, odd_docs, ordered, table
from hypothesis import given, settings
from hypothesis import strategies as st

from wardbook.llm import decontaminate, queries
from wardbook.llm.decontaminate import Automaton, clean, contamination, words


def test_query_equals_brute_force(spark):
    windows = brute.windows_of(table("benchmark", "item_id, text"))
    want = []
    for doc, text in table("documents", "doc_id, text"):
        n, hit, items = brute.contamination(text, windows)
        digest = hashlib.sha256(",".join(map(str, items)).encode()).hexdigest()
        want.append((doc, n, len(hit), len(items), digest, bool(hit)))
    assert ordered(queries.op8_decontaminate(spark, SMALL).collect()) == ordered(want)
    assert any(w[5] for w in want) and not all(w[5] for w in want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=6), st.lists(st.sampled_from("abcx"), max_size=40), st.integers(2, 5))
def test_the_automaton_finds_what_comparing_finds(items, text, size):
    listed = [(i, " ".join(w)) for i, w in enumerate(items)]
    automaton = Automaton([(i, words(t.encode())) for i, t in listed], size)
    spans, found = automaton.find(words(" ".join(text).encode()))
    _, hit, which = brute.contamination(" ".join(text), brute.windows_of(listed, size))
    assert [k for a, b in spans for k in range(a, b)] == hit
    assert found == set(which)


ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "the same row"), (3, "THE same; row"), (4, None), (5, " .,;"), (None, "two words"), (2, "the same row"), (7, "日本語 😀")]


@pytest.mark.parametrize("block_words", [4, decontaminate.BLOCK_WORDS])
def test_odd_rows_and_blocks(spark, block_words):
    more = [(20, "x one two three four five six seven eight nine ten y", "en", "a", 5), (21, LONG + "the same row", "en", "a", 5)]
    docs = odd_docs(spark, more)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    windows = brute.windows_of(ITEMS)
    want = [(r[0], *(x if not isinstance(x, list) else x for x in brute.contamination(r[1], windows))) for r in [*ODD, *more]]
    found = contamination(docs, items, block_words=block_words)
    assert ordered(found.collect()) == ordered((d, n, len(hit), ids) for d, n, hit, ids in want)


def test_spans_are_cut_and_covered_documents_go(spark):
    more = [(20, "x  One-two three four five six seven eight nine ten!  y z and more words here", "en", "a", 5), (21, "The same row.", "en", "a", 13)]
    docs = odd_docs(spark, more)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    windows = brute.windows_of(ITEMS)
    want = []
    for doc, text, lang, source, n in [*ODD, *more]:
        total, hit, _ = brute.contamination(text, windows)
        if 100 * len(hit) <= decontaminate.MAX_COVERAGE * total or not total:
            new = brute.cleaned(text, windows)
            want.append((doc, new, lang, source, len(new) if hit else n))
    assert ordered(kept.select("doc_id", "text", "lang", "source", "n_chars").collect()) == ordered(want)
    assert (20, "x  !  y z and more words here", "en", "a", 29) in want


def test_no_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], DOCS)
    assert contamination(none, items).count() == 0
    docs = odd_docs(spark)
    assert {r.n_hit for r in contamination(docs, items.limit(0)).collect()} == {0}
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ODD)


def test_an_automaton_is_built_once_per_task_and_block(monkeypatch):
    built = []

    class Counted(decontaminate.Automaton):
        def __init__(self, *args):
            built.append(1)
            super().__init__(*args)

    class Shared:
        value = [(1, "one two three four five six seven eight nine ten eleven")]

    monkeypatch.setattr(decontaminate, "Automaton", Counted)
    block = decontaminate._Block(Shared, 10)
    for _ in range(20):
        found = block.find([decontaminate.words(b"x one two three four five six seven eight nine ten"), []])
        assert found == [([(1, 11)], {1}), ([], set())]
    assert built == [1]


def test_twenty_blocks_are_one_benchmark(spark):
    """Hits, items, cut texts and covered documents are the same with one block and with many; copies and nulls included."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(texts).split()[3:16]) or None) for i in range(30)] + [(None, texts[7]), (3, "w1 W2"), (40, "")]
    texts += [texts[5]] * 4 + [None, "", "w1, w2", *(t for _, t in items[:3])]
    docs = spark.createDataFrame([(i % 50, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], DOCS).selectExpr("*", "'x' AS spans", "'y' AS h1", "'z' AS cleaned")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = sum(len((t or "").split()) for _, t in items)
    many = max(1, words // 20)
    assert decontaminate._counted_items(benchmark, "item_id", "text", many)[1] >= 20
    assert ordered(contamination(docs, benchmark, block_words=many).collect()) == ordered(contamination(docs, benchmark).collect())
    assert ordered(clean(docs, benchmark, block_words=many).collect()) == ordered(clean(docs, benchmark).collect())
