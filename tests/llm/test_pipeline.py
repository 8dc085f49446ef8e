"""The pipeline against a plain version of each stage, one after the other."""

from __future__ import annotations

import brute
import corpus_pipeline
import sentencepiece
from helpers import DOCS, MIDDLE, ODD, SMALL, odd_docs, ordered, table

import __spark_entry__
from wardbook.llm import decontaminate, quality_rules, queries, secrets


def plain(rows: list[tuple], labels: list[tuple], items: list[tuple]) -> dict[str, list[tuple]]:
    """What each stage leaves; rows are (doc_id, text)."""
    out = {}
    good = {d for d, q in labels if q == 1}
    scores = brute.ratio_scores([t for _, t in rows], [d in good for d, _ in rows])
    rows = [r for r, s in zip(rows, scores, strict=True) if not brute.rules(r[1])[-1] and s >= quality_rules.THRESHOLD]
    out["quality rules"] = rows
    least = brute.components([d for d, _ in rows], [brute.fingerprint(t) for _, t in rows])
    rows = [r for r, first in zip(rows, least, strict=True) if r[0] == first]
    out["near copies"] = rows
    windows = brute.windows_of(items)
    found = [(r, brute.contamination(r[1], windows)) for r in rows]
    rows = [(d, brute.cleaned(t, windows)) for (d, t), (n, hit, _) in found if not n or 100 * len(hit) <= decontaminate.MAX_COVERAGE * n]
    out["decontamination"] = rows
    masked = []
    for doc, text in rows:
        new, upto = "", 0
        for start, _, end, _ in brute.base_spans(text):
            if start >= upto or not upto:
                new += text[upto:start] + secrets.PLACEHOLDER
            upto = max(upto, end)
        masked.append((doc, new + text[upto:]))
    out["secrets"] = masked
    tokenizer = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_PATH)
    out["tokens"] = [(d, tokenizer.encode(t)) for d, t in masked]
    return out


def test_every_stage_equals_its_plain_version(spark, sf=MIDDLE):
    # Base spans only: on these texts the models add none.
    want = plain(table("documents", "doc_id, text", sf), table("labels", "doc_id, quality", sf), table("benchmark", "item_id, text", sf))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep_table(stage(spark, docs, sf))
        if name != "tokens":
            assert docs.columns == columns
            assert ordered(docs.select("doc_id", "text").collect()) == ordered(want[name]), name
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert sorted((r.doc_id, r.ids) for r in docs.collect()) == sorted(want["tokens"])
    sizes = [len(want[n]) for n, _ in corpus_pipeline.STAGES]
    assert len(table("documents", "doc_id", sf)) > sizes[0] > sizes[1] >= sizes[2] > 0
    assert any(secrets.PLACEHOLDER in t for _, t in want["secrets"])


def test_run_gives_the_last_stage(spark):
    found = __spark_entry__.queries()["pipeline"](spark, SMALL)
    assert found.columns == ["doc_id", "ids", "n_tokens", "round_trip", "parity"]
    assert found.filter("NOT round_trip OR NOT parity").count() == 0
    assert found.count() > 100


def test_stages_take_odd_rows(spark):
    docs = odd_docs(spark, [(300 + i, " ".join(f"w{i}x{j}" for j in range(80)), "en", "a", None) for i in range(3)])
    for name, stage in corpus_pipeline.STAGES:
        found = corpus_pipeline.keep_table(stage(spark, docs, SMALL))
        assert found.count() <= len(ODD) + 3
        if name != "tokens":
            assert found.columns == docs.columns, name


def test_stages_take_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
