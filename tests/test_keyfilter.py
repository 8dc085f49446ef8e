from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardbook.operators.dedup import at_extreme, first_of_scan, one_per_key
from wardbook.operators.joins import FEW_KEYS_CONF, Facts, Look, meet
from wardbook.operators.keyfilter import KeyFilter
from wardbook.plans.registry import run
from wardbook.sources.standins import AS_OF


def nodes(plan):
    """All operators of a plan that ran, through adaptive stages."""
    kind = plan.getClass().getSimpleName()
    yield kind, plan
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def shuffled_rows(df) -> int:
    df.collect()
    return sum(p.metrics().get("shuffleRecordsWritten").get().value() for kind, p in nodes(df._jdf.queryExecution().executedPlan()) if kind == "ShuffleExchangeExec")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_asked_rows_pass_and_most_others_do_not(spark, kind):
    asked = spark.range(0, 100_000, 10).selectExpr(f"CAST(id AS {kind}) AS k", "CAST(id % 7 AS int) AS j").union(spark.sql("SELECT NULL, 1"))
    table = spark.range(200_000).selectExpr(f"CAST(id AS {kind}) AS key", "id % 7 AS other", "'x' AS _words", "2 AS _row2", "CAST(id AS string) AS `a.b`")
    cut = KeyFilter(asked, ["k", "j"], 10_000).cut(table, ["key", "other"])
    assert cut.columns == table.columns
    want = table.join(asked.select("k"), F.col("key") == F.col("k"), "left_semi")
    assert want.exceptAll(cut).count() == 0
    assert cut.exceptAll(table).count() == 0
    assert cut.count() < 10_000 + 0.1 * 200_000


def test_keys_of_other_types_are_not_cut(spark):
    asked = spark.range(10).selectExpr("CAST(id AS string) AS k")
    table = spark.range(20)
    assert rows(KeyFilter(asked, ["k"], 10).cut(table, ["id"])) == rows(table)


def test_no_keys(spark):
    assert KeyFilter(spark.range(0), ["id"], 0).cut(spark.range(20), ["id"]).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_beyond_few_keys_the_looked_up_table_is_cut_before_its_shuffle(spark, how):
    facts = spark.range(0, 40_000, 40).withColumnRenamed("id", "k")
    history = spark.range(0, 400_000).selectExpr("id DIV 10 AS key", "id AS v")
    plain = facts.join(history, F.col("k") == F.col("key"), how).drop("key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = shuffled_rows(facts.join(history, F.col("k") == F.col("key"), how))
        spark.conf.set(FEW_KEYS_CONF, "0")
        found = Facts(facts).by("k", Look(history, "key", how)).df
        assert shuffled_rows(found) < 0.2 * whole
        assert rows(found) == rows(plain)
    finally:
        spark.conf.unset(FEW_KEYS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_emergency_extract_shuffles_a_fraction(spark, tables):
    """The result history beyond few keys: a bitmap of the patients present goes before its shuffle."""
    history = tables.rd.select("*").crossJoin(spark.range(50)).selectExpr("*", "CAST(rdpt_no + id * 1000003 AS long) AS p").drop("rdpt_no", "id").withColumnRenamed("p", "rdpt_no")
    many = tables.replaced(rd=history)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = run("ed_extract", many, AS_OF)
        want = rows(few)
        spark.conf.set(FEW_KEYS_CONF, "0")
        cut = run("ed_extract", many, AS_OF)
        assert rows(cut) == want
        assert shuffled_rows(cut) < 0.25 * history.where(F.col("rdts").contains("COV")).count() + 20 * tables.rmbed.count()
    finally:
        spark.conf.unset(FEW_KEYS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["ssi_denominator", "bed_extract", "or_log_month"])
def test_no_rows_are_sorted_to_be_aggregated(tables, name):
    plan = run(name, tables, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("lead", ["t", "s"])
def test_first_of_scan_is_one_per_key(spark, keep, lead):
    data = [(i % 5 if i % 11 else None, (i * 7) % 4 if i % 6 else None, f"s{(i * 13) % 6}" if i % 8 else None, i % 9) for i in range(400)] + [(9, None, None, 1)] * 2
    df = spark.createDataFrame(data, "k int, t int, s string, v int")
    order = [lead, "v"]
    best = {}
    for r in data:
        key = tuple((x is not None, x) if x is not None else (False,) for x in (r[1] if lead == "t" else r[2], r[3], r[2] if lead == "t" else r[1]))
        if r[0] not in best or (key < best[r[0]][0] if keep == "first" else key > best[r[0]][0]):
            best[r[0]] = (key, r)
    want = sorted((r for _, r in best.values()), key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert rows(first_of_scan(df, "k", order, keep)) == rows(one_per_key(df, "k", order, keep)) == want


def test_the_extreme_keeps_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (None, 2, "d"), (None, None, "e"), (2, None, "f")], "k int, t int, v string")
    assert {r["v"] for r in at_extreme(df, "k", "t", "last").collect()} == {"a", "b", "d", "f"}
    assert {r["v"] for r in at_extreme(df, "k", "t", "first").collect()} == {"c", "e", "f"}


def test_a_hot_key_is_ranked_in_its_tasks(spark):
    """Rows of one key: each task sends on one of them."""
    df = spark.range(0, 200_000, 1, 8).selectExpr("1 AS k", "id % 1000 AS t", "CAST(id AS string) AS v")
    found = one_per_key(df, "k", ["t"])
    assert shuffled_rows(found) <= 8
    assert rows(found) == [(1, 0, "0")]


@pytest.mark.parametrize("few", ["0", "100"])
def test_a_history_meets_a_list(spark, few):
    """Repeated keys on both sides, a hot one, and keys that are missing."""
    history = spark.createDataFrame([(i % 7 if i % 5 else None, 1, i) for i in range(300)] + [(3, 1, -i) for i in range(200)], "p long, o int, v int")
    asked = spark.createDataFrame([(2, 1, "a"), (2, 1, "b"), (3, 1, "c"), (9, 1, "d"), (None, 1, "e")], "q long, r int, w string")
    spark.conf.set(FEW_KEYS_CONF, few)
    try:
        found = meet(history, ["p", "o"], asked, ["q", "r"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(history.join(asked, (F.col("p") == F.col("q")) & (F.col("o") == F.col("r"))).drop("q", "r"))
        assert ("BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan) or few == "0"
    finally:
        spark.conf.unset(FEW_KEYS_CONF)


@pytest.mark.parametrize(("name", "most"), [("lab_tat", 5), ("virus_summary", 6), ("billing_demo", 9), ("admit_split", 2), ("infection_mdro", 2)])
def test_jobs_before_a_report_runs(spark, tables, name, most):
    """Counting takes few Spark jobs (one per shuffle stage)."""
    spark.sparkContext.setJobGroup(f"jobs {name}", name)
    try:
        assert run(name, tables, AS_OF).columns
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"jobs {name}")) <= most
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
