from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardbook.operators.counts import add_metrics, group_size, metric_rows, metric_table, non_null_counts, value_counts
from wardbook.operators.dedup import copies, expand_copies, lookup, one_per_key
from wardbook.operators.joins import (
    FEW_KEYS_CONF,
    ROWS_PER_SLOT_CONF,
    Facts,
    Look,
    cut_all,
    cut_to,
    equi_join,
    in_roster,
    join_chain,
    merge,
    not_in_roster,
    role,
    split_matched,
    stack_sources,
    with_details,
)
from wardbook.operators import prefixes
from wardbook.operators.prefixes import keyword_filter, prefix_join, shortest_prefixes
from wardbook.operators.shape import contract, nothing, ordered, sections, spaced


@pytest.fixture(scope="module")
def facts(spark):
    """Three hundred facts: a third on one key, some without a key, some on a key nobody knows."""
    pick = random.Random(7)
    data = []
    for i in range(300):
        key = 1 if i % 3 == 0 else pick.choice([None, 2, 3, 4, 5, 99])
        data.append((i, key, pick.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id int, k long, v string")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei"), (3, None), (7, "seven"), (None, "none")], "key long, name string")


@pytest.mark.parametrize("few", ["0", "1000"])
@pytest.mark.parametrize("slot", ["3", "40", "1000"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_facts_give_the_plain_join(spark, facts, names, how, slot, few, few_rows_per_slot):
    spark.conf.set(ROWS_PER_SLOT_CONF, slot)
    spark.conf.set(FEW_KEYS_CONF, few)
    plain = facts.join(names, facts.k == names.key, how)
    plain = plain.drop("key") if how in ("inner", "left") else plain
    assert rows(Facts(facts).by("k", Look(names, "key", how)).df) == rows(plain)


def test_facts_chain_lookups_and_keys(facts, names, spark, few_rows_per_slot):
    codes = spark.createDataFrame([("a", 10), ("b", 20)], "code string, points int")
    pairs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, v string, pair string")
    found = (
        Facts(facts)
        .by("k", Look(names, "key"), Look(role(names, "_2"), "key_2", "inner"))
        .by(["k", "v"], Look(pairs, ["k", "v"]))
        .by("v", Look(codes, "code"))
        .where(F.col("points") > 0)
        .df
    )
    want = (
        facts.join(names, facts.k == names.key, "left").drop("key")
        .join(role(names, "_2"), F.col("k") == F.col("key_2")).drop("key_2")
        .join(pairs, ["k", "v"], "left").join(codes, F.col("v") == F.col("code"), "left").drop("code").where("points > 0")
    )
    assert rows(found) == rows(want.select(*found.columns))


def test_few_keys_cut_the_looked_up_table_before_its_shuffle(spark, facts, names):
    found = Facts(facts.where("k = 2")).by("k", Look(names.groupBy("key").agg(F.max("name").alias("name")), "key")).df
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The keys go below the aggregation.
    assert plan.index("Aggregate [key") < plan.index("LeftSemi")
    assert {r["name"] for r in found.collect()} == {"zwei"}


@pytest.mark.parametrize("few", ["1", "100"])
def test_cut_to_a_short_list(spark, facts, few):
    spark.conf.set(FEW_KEYS_CONF, few)
    try:
        asked = spark.createDataFrame([(2,), (2,), (5,), (None,)], "p long")
        cut = cut_to(facts, "k", asked, "p")
        assert rows(cut) == rows(facts.where("k IN (2, 5)") if few == "100" else facts)
    finally:
        spark.conf.unset(FEW_KEYS_CONF)


def test_keys_are_counted_in_one_job(spark, facts, names, monkeypatch):
    """However many keys: one pass, and one more to write the list of hot keys if there are any."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counting", "counting")
    try:
        three = Facts(facts).by("k", Look(names, "key")).by("v", Look(names, "name")).by(["k", "v"], Look(names, ["key", "name"]))
        assert three.df.columns
        actions = spark.sparkContext._jsc.sc().listenerBus()
        actions.waitUntilEmpty(10_000)
        # Shuffle stages of one action may be jobs of their own; a second pass over the facts would double them.
        assert len(tracker.getJobIdsForGroup("counting")) <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_third_of_the_rows_without_a_key(spark, names, few_rows_per_slot):
    data = [(i, None if i % 3 == 0 else i % 9) for i in range(900)]
    facts = spark.createDataFrame(data, "id int, k long")
    for how in ("left", "inner", "left_anti"):
        plain = facts.join(names, facts.k == names.key, how)
        plain = plain.drop("key") if how != "left_anti" else plain
        assert rows(Facts(facts).by("k", Look(names, "key", how)).df) == rows(plain)


def test_the_list_is_counted_without_a_single_task(spark, facts):
    """No exchange brings the keys themselves to one task; only the counts meet."""
    asked = spark.createDataFrame([(2,), (5,)], "p long")
    plan = cut_all([(facts, "k")], asked, "p")[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "LeftSemi" in plan


def test_facts_refuse_a_key_that_is_not_theirs(facts, names):
    with pytest.raises(ValueError):
        Facts(facts).by("name", Look(names, "key"))


def test_hot_and_missing_keys_are_spread(spark, facts, names, few_rows_per_slot):
    """No task gets the hot key, or the rows without a key, whole."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = Facts(facts).by("k", Look(names, "key")).df.withColumn("part", F.spark_partition_id())
        for key in ("k = 1", "k IS NULL"):
            sizes = [r["count"] for r in found.where(key).groupBy("part").count().collect()]
            assert len(sizes) > 4
            assert max(sizes) < sum(sizes) / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rosters(facts, spark):
    roster = spark.createDataFrame([(1,), (1,), (2,), (None,)], "key long")
    assert rows(in_roster(facts, roster, "k", "key")) == rows(facts.where("k IN (1, 2)"))
    known = roster.dropna()
    assert rows(not_in_roster(facts, known, "k", "key")) == rows(facts.where("k NOT IN (1, 2)"))


def test_split_keeps_every_row_once(facts, spark, few_rows_per_slot):
    other = spark.createDataFrame([(1,), (1,), (3,)], "key long")
    matched, unmatched = split_matched(facts, other, "k", "key")
    assert rows(matched) == rows(facts.where("k IN (1, 3)"))
    assert rows(stack_sources(matched, unmatched)) == rows(facts)


def test_details_of_hot_heads_and_bare_heads(spark, facts, few_rows_per_slot):
    heads = spark.createDataFrame([(1, "h1"), (2, "h2"), (50, "bare"), (None, "no key")], "h long, head string")
    want = heads.join(facts, heads.h == facts.k, "left").drop("k")
    found = with_details(heads, facts, "h", "k")
    assert rows(found.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("how", ["inner", "left", "full_outer"])
def test_merge(spark, facts, how, few_rows_per_slot):
    right = spark.createDataFrame([(1, "one"), (2, "two"), (70, "seventy"), (None, "none")], "k long, name string")
    got = merge(facts, right, "k", how, row_key=["id"])
    r = right.withColumnRenamed("k", "rk")
    want = facts.join(r, facts.k == r.rk, how).withColumn("k", F.coalesce("k", "rk")).select(*got.columns)
    assert rows(got) == rows(want)


def test_merge_refuses_other_kinds(facts, names):
    with pytest.raises(ValueError):
        merge(facts, names, "k", "right")


def test_join_chain_keeps_fan_out(spark):
    base = spark.createDataFrame([(1,), (2,)], "a int")
    many = spark.createDataFrame([(1, "x"), (1, "y")], "b int, v string")
    chained = join_chain(base, [(many, "a", "b"), (many.withColumnsRenamed({"b": "c", "v": "w"}), "a", "c", "inner")])
    assert chained.count() == 4
    assert join_chain(base, [(many, "a", "b")]).select("a").count() == 3


def test_one_per_key_against_brute_force(spark):
    pick = random.Random(3)
    data = [(pick.choice([None, 1, 2, 3]), pick.choice([None, 5, 6]), pick.choice(["x", "y", None]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k int, o int, v string, i int")

    def rank(row):
        return tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (True, x) for x in (row[1], row[2] or "", row[3]))

    for keep, choose in (("first", min), ("last", max)):
        want = []
        for key in {r[0] for r in data}:
            # None sorts first in both; '' stands for it in the text column, which has no ''.
            want.append(choose((r for r in data if r[0] == key), key=rank))
        got = one_per_key(df, "k", ["o"], keep)
        assert got.columns == df.columns
        assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_lookup_last_row_wins(spark, few_rows_per_slot):
    cases = spark.createDataFrame([(10, "c1"), (10, "c2"), (11, "c3"), (None, "c4")], "pat long, c string")
    answers = spark.createDataFrame([(10, 1, "old"), (10, 2, "new"), (12, 1, "x")], "p long, at int, answer string")
    got = lookup(cases, answers, "pat", "p", ["answer"], ["at"])
    assert rows(got) == rows(spark.createDataFrame([(10, "c1", "new"), (10, "c2", "new"), (11, "c3", None), (None, "c4", None)], "pat long, c string, a string"))
    empty = lookup(cases, answers.where("p < 0"), "pat", "p", ["answer"], ["at"])
    assert empty.where("answer IS NOT NULL").count() == 0 and empty.count() == 4


def test_counts(spark):
    df = spark.createDataFrame([("S", 1), ("S", 2), ("U", None), (None, 4)], "s string, n int")
    assert [tuple(r) for r in value_counts(df, "s").collect()] == [("S", 2), ("U", 1)]
    assert dict(map(tuple, value_counts(df, "s", weight="n", order=False).collect())) == {"S": 3, "U": None}
    assert rows(group_size(df, ["s", "n"])) == [("S", 1, 1), ("S", 2, 1)]
    assert tuple(non_null_counts(df).first()) == (3, 3)
    assert tuple(non_null_counts(df, weight="n").first()) == (3,)
    table = metric_table(df, {"sent": F.col("s") == "S", "none": F.col("s") == "?"})
    assert dict(map(tuple, table.collect())) == {"sent": 2, "none": 0}
    weighted = metric_table(df, {"sent": F.col("s") == "S"}, weight="n")
    assert dict(map(tuple, weighted.collect())) == {"sent": 3}
    one = df.agg(F.count("s").alias("a"), F.count("n").alias("b"))
    parts = metric_rows(one, {"a": ["first", "both"], "b": ["both"]})
    assert dict(map(tuple, add_metrics(parts, parts).collect())) == {"first": 6, "both": 12}


def test_copies_come_back(spark, facts):
    counted = copies(facts, ["k", "v"])
    assert rows(expand_copies(counted)) == rows(facts.select("k", "v"))
    for at_once in (1, 7, 100, 101):
        assert rows(expand_copies(counted, at_once=at_once)) == rows(facts.select("k", "v"))


def test_copies_of_one_row_are_the_work_of_many_tasks(spark):
    one = spark.createDataFrame([("x", 1_000_000), ("y", 0), ("z", None)], "v string, copies long")
    out = expand_copies(one)
    assert out.groupBy("v").count().collect() == [("x", 1_000_000)]
    lists = out._jdf.queryExecution().optimizedPlan().toString()
    assert lists.count("Generate explode(sequence(") == 2 and "Rebalance" in lists


PREFIXES = ["SMI", "SMITH", "JO", "50%", "A_", "SMITH"]
AUTHORS = ["SMITH, A", "SMIT", "SMI", "SM", "JONES", "50% OFF", "500", "A_B", "AXB", "", None]


@pytest.mark.parametrize("few", [0, 100])
def test_prefixes_against_brute_force(spark, few, few_rows_per_slot, monkeypatch):
    monkeypatch.setattr(prefixes, "FEW_PREFIXES", few)
    notes = spark.createDataFrame(list(enumerate(AUTHORS)), "i int, author string")
    roster = spark.createDataFrame([(p,) for p in PREFIXES], "prefix string")
    want = Counter((i, a, p) for i, a in enumerate(AUTHORS) for p in PREFIXES if a is not None and a.startswith(p))
    got = prefix_join(notes, roster, "author")
    assert Counter(tuple(r) for r in got.select("i", "author", "prefix").collect()) == want
    exists = prefix_join(notes, roster, "author", keep="exists")
    assert sorted(r["i"] for r in exists.collect()) == sorted({i for i, _, _ in want})
    assert exists.columns == notes.columns
    listed = prefix_join(notes, PREFIXES, "author")
    assert Counter(tuple(r) for r in listed.select("i", "author", "prefix").collect()) == want
    assert rows(prefix_join(notes, PREFIXES, "author", keep="exists")) == rows(exists)
    assert prefix_join(notes, [], "author").columns == ["i", "author", "prefix"] and prefix_join(notes, [""], "author").count() == 0
    nobody = roster.where("prefix = '?'")
    assert prefix_join(notes, nobody, "author").columns == ["i", "author", "prefix"]
    assert prefix_join(notes, nobody, "author").count() == prefix_join(notes, nobody, "author", keep="exists").count() == 0


def test_the_range_of_a_roster_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "notes")
    texts = ["a", "ab", "abz", "az", "b", "ba", "B", "", None, "a\U0010ffff", "\ud7ff1", "\ue000", "\U0010ffffx", "ä"]
    spark.createDataFrame(list(enumerate(texts)), "i int, author string").write.parquet(path)
    notes = spark.read.parquet(path)
    for listed in (["a", "ab"], ["ab", "abc"], ["b"], ["\ud7ff"], ["\U0010ffff"], ["a\U0010ffff"], ["a", "ä", "B"]):
        roster = spark.createDataFrame([(p,) for p in listed], "prefix string")
        want = sorted(i for i, a in enumerate(texts) if a is not None and a.startswith(tuple(listed)))
        found = prefix_join(notes, roster, "author", keep="exists")
        assert sorted(r["i"] for r in found.collect()) == want, listed
    plan = prefix_join(notes, spark.createDataFrame([("ab",), ("abc",)], "prefix string"), "author")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(author,ab)" in plan and "LessThan(author,ac)" in plan


def test_shortest_prefixes(spark):
    roster = spark.createDataFrame([(p,) for p in ("SMI", "SMITH", "JO", "JOHN", "JOHNSON", "K")], "prefix string")
    assert sorted(r[0] for r in shortest_prefixes(roster).collect()) == ["JO", "K", "SMI"]


def test_keyword_filter(spark):
    df = spark.createDataFrame([("HIP ARTHROPLASTY",), ("HERNIA",), (None,)], "p string")
    assert keyword_filter(df, ["ARTHRO", "OSTEO"], "p").count() == 1


def test_shapes(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (None, "a")], "n int, s string")
    assert [r["n"] for r in ordered(df, "n").collect()] == [1, 2, None]
    assert [r["n"] for r in ordered(df, "n", nulls="first").collect()] == [None, 1, 2]
    out = contract(df, ["s", ("n_2", "n"), ("fixed", F.lit("x")), ("empty", nothing())])
    assert out.columns == ["s", "n_2", "fixed", "empty"]
    assert {k: v.count() for k, v in sections(df, "s", ["a", "b", "c"]).items()} == {"a": 1, "b": 1, "c": 0}


def test_spacers(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    lines = spaced(df, 2).orderBy("_sort", "line").drop("_sort")
    assert [tuple(r) for r in lines.collect()] == [
        (1, "a", 0), (None, None, 1), (None, None, 2), (2, "b", 0), (None, None, 1), (None, None, 2),
    ]


def test_equi_join_semi_keeps_left_columns(spark, facts, names):
    assert equi_join(facts, names, "k", "key", "left_semi").columns == facts.columns
