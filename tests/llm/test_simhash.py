from __future__ import annotations

import brute
import numpy as np
import pytest
from helpers import DOCS, LONG, ODD, SMALL, odd_docs, ordered, table
from hypothesis import given, settings
from hypothesis import strategies as st

from wardbook.llm import queries, simhash


def gray_sorted(codes) -> np.ndarray:
    codes = np.unique(np.array(codes, np.uint64))
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return codes[np.argsort(rank)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.lists(st.lists(st.integers(0, 63), max_size=5), max_size=40), st.integers(0, 6))
def test_the_index_finds_what_all_pairs_find(bases, flips, distance):
    codes = list(bases)
    for i, bits in enumerate(flips):
        code = bases[i % len(bases)]
        for b in bits:
            code ^= 1 << b
        codes.append(code)
    codes = gray_sorted(codes)
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= distance}
    found = simhash.GrayIndex(codes).search(np.arange(len(codes)), distance)
    assert set(zip(*(x.tolist() for x in found), strict=True)) == want
    first = simhash.GrayIndex(codes).stars(distance).tolist()
    expected = brute.components(list(range(len(codes))), [int(c) for c in codes], distance)
    assert first == expected


def test_query_equals_brute_force(spark):
    rows = table("documents", "doc_id, text")
    codes = [brute.fingerprint(t) for _, t in rows]
    want = ordered(zip([d for d, _ in rows], [f"{c:016x}" for c in codes], brute.components([d for d, _ in rows], codes), strict=True))
    assert ordered(queries.op1_simhash(spark, SMALL).collect()) == want
    assert len({w[2] for w in want}) < len(want)


def near(n: int) -> list[tuple]:
    """Near copies of one text, which the same blocks of bits hold."""
    words = [f"word{i}" for i in range(400)]
    out = []
    for i in range(n):
        changed = [*words]
        changed[i] = "other"
        out.append((1000 + i, " ".join(changed), "en", "a", None))
    return out


@pytest.mark.parametrize("group_rows", [4, simhash.GROUP_ROWS])
def test_odd_rows_and_large_groups(spark, group_rows):
    more = [*near(25), (2000, LONG, "en", "a", 1)]
    docs = odd_docs(spark, more)
    rows = [(r[0], r[1]) for r in [*ODD, *more]]
    codes = [brute.fingerprint(t) for _, t in rows]
    want = ordered((d, c - (c >> 63 << 64), k) for (d, _), c, k in zip(rows, codes, brute.components([d for d, _ in rows], codes), strict=True))
    found = simhash.near_duplicates(docs, group_rows=group_rows).select("doc_id", "code", "component_id")
    assert ordered(found.collect()) == want


def test_one_row_of_each_component_stays(spark):
    docs = odd_docs(spark, near(6))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = [(r[0], r[1]) for r in [*ODD, *near(6)]]
    codes = [brute.fingerprint(t) for _, t in rows]
    of = zip(brute.components(list(range(len(rows))), codes), brute.components([d for d, _ in rows], codes), strict=True)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least for _, least in set(of))


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0


def test_rows_without_any_id(spark):
    docs = spark.createDataFrame([(None, "x y z", None, None, None)] * 3, DOCS)
    assert [r.component_id for r in simhash.near_duplicates(docs).collect()] == [None] * 3
    assert simhash.keep_first(docs).count() == 1


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_wider_tables_find_the_same_components(spark, distance):
    rng = np.random.default_rng(7)
    bases = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = {int(b) for b in bases}
    for b in bases:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            codes.add(int(b) ^ sum(1 << int(f) for f in flips))
    ordered_codes = sorted(codes)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in ordered_codes], "code long")
    label = brute.components(ordered_codes, ordered_codes, distance)
    want = {c: root for c, root in zip(ordered_codes, label, strict=True)}
    for blocks in (distance + 1, distance + 2, distance + 3, distance + 4):
        stars = simhash.components(simhash.links(frame, distance, blocks=blocks)).collect()
        of = {c: c for c in ordered_codes} | {r.node % (1 << 64): r.root % (1 << 64) for r in stars}
        assert len({(want[c], of[c]) for c in ordered_codes}) == len(set(want.values())) == len(set(of.values()))


def test_copies_are_bounded_whatever_the_number_of_codes():
    for n in (0, 1, 10**6, 10**9, 4 * 10**10, 10**12, 10**15):
        blocks = simhash.blocks_for(n)
        masks = simhash.shared_bits(blocks)
        assert len(masks) <= 35
        width = 64 * (blocks - 3) // blocks
        assert blocks == 7 or n >> width <= simhash.GROUP_ROWS // 4
        assert all(m.bit_count() >= width - 1 for m in masks)
    assert simhash.blocks_for(10**8) == 4 and simhash.blocks_for(4 * 10**10) < 7
