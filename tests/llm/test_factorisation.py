from __future__ import annotations

import zlib

import numpy as np
import pytest
from helpers import DOCS, LONG, MIDDLE, ODD, SMALL, odd_docs, table

from wardbook.llm import factorisation, queries
from wardbook.llm.factorisation import FEATURES, RANK, Machine, classify, features, train


def test_the_identity_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = Machine(1)
    machine.bias, machine.weights = 0.3, rng.normal(size=FEATURES)
    machine.factors = rng.normal(size=(FEATURES, RANK))
    index, value = np.array([3, 17, 900, 16_000, 3]), rng.normal(size=5)
    pairs = sum(float(machine.factors[index[i]] @ machine.factors[index[j]]) * value[i] * value[j] for i in range(5) for j in range(i))
    want = 0.3 + float(machine.weights[index] @ value) + pairs
    assert machine.margin(index, value, np.zeros(1, np.int64))[0] == pytest.approx(want)


def test_interactions_are_learned():
    """Marks that no weight per feature can tell: good where both or neither of two words stand."""
    texts = [b"aa bb", b"cc dd", b"aa dd", b"cc bb"] * 60
    rows = [features(t, 5) for t in texts]
    marks = np.array([1.0, 1.0, 0.0, 0.0] * 60)
    machine = Machine().fit(rows, marks, epochs=80)
    assert [round(machine.score(t, 5)) for t in texts[:4]] == [1, 1, 0, 0]


def test_held_out_accuracy(spark):
    marks = dict(table("labels", "doc_id, quality", MIDDLE))
    found = queries.op4_quality_classifier(spark, MIDDLE).collect()
    assert len(found) == 1000
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(r.predicted, marks[r.doc_id]) for r in found if r.held_out and r.doc_id in marks]
    assert len(judged) > 80
    assert sum(p == m for p, m in judged) / len(judged) > 0.95


def test_learned_from_the_other_fold_alone(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = (classify(docs, train(docs, ls)).orderBy("doc_id").collect() for ls in (labels, turned))
    assert a == b
    other = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source", "n_chars")
    assert classify(other, train(other, labels)).orderBy("doc_id").collect() == a


def test_odd_rows_and_labels(spark):
    more = [(100 + i, ("good words here. " * 30) if i % 2 else "!!! ### " * 30, "en", "a", 400) for i in range(40)]
    docs = odd_docs(spark, [*more, (3000, LONG, "en", "a", 1)])
    marks = [(100 + i, i % 2, 0) for i in range(40)] + [(9, 1, 0), (9, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, 0), (99999, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = classify(docs, train(docs, labels)).collect()
    assert len(found) == len(ODD) + 41
    by_id = {r.doc_id: r.predicted for r in found}
    assert [by_id[100 + i] for i in range(4)] == [0, 1, 0, 1]
    few = train(docs, labels, max_training=10)
    assert isinstance(few, Machine | float)


def test_nothing_to_learn(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in classify(docs, train(docs, labels)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.score for r in classify(docs, train(docs, ones)).collect()} == {0.99}
    none = spark.createDataFrame([], DOCS)
    assert classify(none, train(none, ones)).count() == 0
    assert factorisation.classify(docs.drop("n_chars"), 0.7).count() == len(ODD)


def test_only_the_chosen_rows_move_to_the_training_task(spark):
    """The scan and the join stay with the tasks they have; one task would read all documents behind a coalesce."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    plan = factorisation.training_rows(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Exchange SinglePartition" in plan
