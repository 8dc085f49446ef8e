from __future__ import annotations

import brute
import numpy as np
import pytest
from helpers import DOCS, LONG, ODD, SMALL, odd_docs, ordered, table

from wardbook.llm import quality_rules, queries


def want(rows: list[tuple], good: set) -> list[tuple]:
    texts = [t for _, t in rows]
    scores = brute.ratio_scores(texts, [d in good for d, _ in rows])
    out = []
    for (doc, text), score in zip(rows, scores, strict=True):
        found = brute.rules(text)
        out.append((doc, *found, not found[-1] and score >= quality_rules.THRESHOLD, round(score, 9)))
    return out


def test_query_equals_brute_force(spark):
    rows = table("documents", "doc_id, text")
    good = {d for d, q in table("labels", "doc_id, quality") if q == 1}
    expected = want(rows, good)
    found = [(*r[:-1], round(r[-1], 9)) for r in queries.op7_quality_rules(spark, SMALL).collect()]
    assert ordered(found) == ordered(expected)
    marks = dict(table("labels", "doc_id, quality"))
    judged = [(kept, marks[d]) for d, *_, failed, kept, _ in expected if d in marks and not failed]
    assert all(kept for kept, mark in judged if mark == 1)
    assert sum(not kept for kept, mark in judged if mark == 0) > 0


def test_odd_rows_and_labels(spark):
    clean = "plain words that stand in ordinary order with nothing odd about them at all "
    more = [(100 + i, clean * 8 if i % 2 else f"#{i}%%% $$$ |||&&& <{i}> " * 30, "en", "a", None) for i in range(12)]
    more += [(200 + i, " ".join(f"{clean[j % 40 : j % 40 + 6]}{i}{j}" for j in range(60)), "en", "a", None) for i in range(6)] + [(3000, LONG, "en", "a", 1)]
    docs = odd_docs(spark, more)
    marks = [(200 + i, 1) for i in range(6)] + [(9, 1), (9, 1), (6, 1), (6, 0), (None, 1), (7, None), (99999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    rows = [(r[0], r[1]) for r in [*ODD, *more]]
    expected = want(rows, {9, *range(200, 206)})
    found = [(*r[:-1], round(r[-1], 9)) for r in quality_rules.quality_rules(docs, labels).collect()]
    assert ordered(found) == ordered(expected)
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert ordered((r.doc_id,) for r in kept.collect()) == ordered((w[0],) for w in expected if w[7])


def test_without_labels_the_counted_rules_decide(spark):
    docs = odd_docs(spark, [(300, " ".join(f"w{i}" for i in range(60)), "en", "a", None)])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality_rules.quality_rules(docs, labels).collect()
    assert {r.score for r in found} == {0.0}
    assert [r.doc_id for r in found if r.kept] == [300]
    assert quality_rules.quality_rules(spark.createDataFrame([], DOCS), labels).count() == 0


@pytest.mark.parametrize("size", [0, 3, 4, 5, 1000])
def test_buckets_of_long_texts_come_in_pieces(size, monkeypatch):
    text = bytes(np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8))
    whole = [b for part in quality_rules.buckets(text) for b in part.tolist()]
    monkeypatch.setattr(quality_rules, "_PIECE", 7)
    assert [b for part in quality_rules.buckets(text) for b in part.tolist()] == whole
    assert whole == [(int.from_bytes(text[i : i + 4], "big") * 2654435761 % 2**32) >> 16 for i in range(max(0, size - 3))]


def test_the_bound_on_trusted_documents(spark):
    labels = spark.range(100).selectExpr("id AS doc_id", "1 AS quality")
    a = {r.doc_id for r in quality_rules.trusted_ids(labels, 10).collect()}
    b = {r.doc_id for r in quality_rules.trusted_ids(labels.repartition(7), 10).collect()}
    assert a == b and len(a) == 10


def test_every_trusted_document_counts_however_many(spark):
    docs = odd_docs(spark, [(3000, LONG, "en", "a", 1), (3000, "the long one's id again", "en", "a", 1)])
    labels = spark.createDataFrame([(i, 1) for i in (5, 6, 9, 10, 12, 3000, 99999)] + [(7, 0), (8, 0), (8, 1), (None, 1)], "doc_id int, quality int")
    broadcast, moved = (quality_rules.log_ratios(docs, labels, broadcast_ids=n) for n in (7, 3))
    assert np.array_equal(broadcast, moved)
    assert np.count_nonzero(moved) > 0
