from __future__ import annotations

import math
import random
import re

import brute
import pytest
from helpers import DOCS, ODD, SMALL, odd_docs, ordered, table

from wardbook.llm import queries
from wardbook.llm.licenses import PHRASES, TEMPLATES, Notices, license_scan


def plain(text: str | None, templates=TEMPLATES, share: float = 0.8) -> tuple:
    """Every block against every template."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or ""))
    cut = [(label, re.findall(r"[0-9a-z]+", t.lower())) for label, t in templates]
    step = max(len(t) for _, t in cut)
    found: dict[str, float] = {}
    for at in range(0, max(1, len(words)), step):
        block = words[at : at + 2 * step]
        have = set(zip(block, block[1:], strict=False))
        for label, t in cut:
            tokens = set(zip(t, t[1:], strict=False))
            if len(have & tokens) >= math.ceil(share * len(tokens) - 1e-9):
                found[label] = max(found.get(label, 0), len(have & tokens) / len(tokens))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts, base = [i for i, _ in places], {label for _, label in places}
    score = 1.0 if places else max(found.values(), default=0.0)
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(found))), score


def test_query_equals_brute_force(spark):
    want = ordered((d, *plain(t)) for d, t in table("documents", "doc_id, text"))
    assert ordered(queries.op12_licenses(spark, SMALL).collect()) == want
    assert {label for w in want for label in w[6].split(",")} > {"apache-2.0", "reserved"}


@pytest.mark.parametrize("share", [0.5, 0.8, 1.0])
def test_altered_notices_at_every_place(spark, share):
    """Notices with words lost or changed, across the edges of blocks, several in a text, between words of other notices."""
    rng = random.Random(5)
    pool = [w for _, t in TEMPLATES for w in t.split()] + ["lorem", "ipsum", "Äpfel", "dolor"]
    texts = []
    for n in range(120):
        parts = [rng.choice(pool) if n % 2 else "lorem" for _ in range(rng.randrange(150))]
        for _, t in rng.sample(TEMPLATES, rng.randrange(3)):
            notice = [w for w in t.split() if rng.random() > rng.choice((0, 0.05, 0.1))]
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = notice
        texts.append(rng.choice((" ", "\n", ", ")).join(parts))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert ordered(license_scan(docs, share=share).collect()) == ordered((i, *plain(t, share=share)) for i, t in enumerate(texts))


def test_odd_rows(spark):
    long = "All rights reserved. " * 40_000 + TEMPLATES[1][1] + " lorem" * 50_000 + " CC-BY"
    more = [(50, long, "en", "a", 1), (51, "lorem " * 99 + TEMPLATES[8][1].replace("free ", ""), "en", "a", 1), (52, "cc", None, None, None), (52, "cc\x00by", None, None, None)]
    rows = [(r[0], r[1]) for r in [*ODD, *more]]
    docs = odd_docs(spark, more).selectExpr("*", "'x' AS row", "'x' AS blocks", "'x' AS labels", "'x' AS label", "'x' AS share")
    assert ordered(license_scan(docs).collect()) == ordered((d, *plain(t)) for d, t in rows)
    assert license_scan(spark.createDataFrame([], DOCS)).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError, match="two words"):
        Notices([("a", "word")], 0.8)
    with pytest.raises(ValueError, match="more than"):
        Notices([("a", "word " * 1_000_001)], 0.8)
