from __future__ import annotations

import random

import brute
import pytest
from helpers import SMALL, ordered, table

from wardbook.llm import queries
from wardbook.llm.chats import END, START, collapse_and_render, prefix_hashes

ROWS = "conv_id long, turn long, role string, text string"


def rendered(turns) -> str:
    return "".join(f"{START}{'unknown' if r is None else r}\n{t or ''}{END}\n" for r, t in turns)


def want(rows: list[tuple]) -> list[tuple]:
    return ordered((c, n, copies, rendered(turns)) for c, n, copies, turns in brute.chats(rows))


def test_query_equals_brute_force(spark):
    rows = table("conversations", "conv_id, turn, role, text")
    assert ordered(queries.op9_chats(spark, SMALL).collect()) == want(rows)


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_collapse(spark, seed):
    rng = random.Random(seed)
    rows = []
    for base in range(6):
        turns = [(rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "", None, "long text", "same first turn"])) for _ in range(rng.randint(1, 6))]
        for snapshot in range(rng.randint(1, 5)):
            step = rng.choice([1, 10])
            n = rng.randint(1, len(turns))
            rows += [(100 * base + snapshot, step * i, *turns[i]) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS place", "'y' AS h1", "'z' AS n_turns", "'w' AS kept_id")
    assert ordered(collapse_and_render(df).collect()) == want(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b"), (None, 0, "user", "a"), (None, 1, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, None, "a"), (5, 0, "user", None), (6, 0, "user", ""), (7, 0, None, None), (8, 0, "a" * 100_000, "b" * 100_000)]
    found = ordered(collapse_and_render(spark.createDataFrame(rows, ROWS)).collect())
    assert found == want(rows)
    assert (2, 2, 2, rendered([("user", "a"), ("user", "b")])) in found
    assert collapse_and_render(spark.createDataFrame([], ROWS)).count() == 0


def test_a_null_turn_comes_first(spark):
    rows = [(1, None, "user", "b"), (1, 0, "user", "a")]
    assert collapse_and_render(spark.createDataFrame(rows, ROWS)).first()["rendered"] == rendered([("user", "b"), ("user", "a")])


@pytest.mark.parametrize("conv", [1, None])
def test_a_long_conversation_is_many_parts(spark, conv):
    """Equal turns too are dealt over the parts; places and hashes are those of one part."""
    rows = [(conv, i, ["user", None, "assistant"][i % 3], f"text {i % 5}") for i in range(400)] + [(conv, 1000, "user", "same")] * 200
    rows += [(i, 0, "user", "hi") for i in range(2, 40)] + [(99, i, ["user", None, "assistant"][i % 3], f"text {i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, ROWS)
    one, many = (ordered(prefix_hashes(df, parts).collect()) for parts in (1, 9))
    assert one == many
    assert sorted(r[1] for r in many if r[0] == conv) == list(range(1, 601))
    assert ordered(collapse_and_render(df).collect()) == want(rows)


def test_one_very_long_turn(spark):
    rows = [(1, 0, "user", "x" * 3_000_000), (1, 1, "assistant", "y"), (2, 0, "user", "x" * 3_000_000), (3, 0, "user", "x" * 2_999_999)]
    assert ordered(collapse_and_render(spark.createDataFrame(rows, ROWS)).collect()) == want(rows)
