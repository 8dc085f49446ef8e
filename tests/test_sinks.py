from __future__ import annotations

from datetime import date, datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from wardbook.sinks import reports


def lines(path) -> list[str]:
    out = []
    for name in sorted(glob(f"{path}/part-*")):
        with open(name) as f:
            out += f.read().splitlines()
    return out


def test_report_of_sections(spark, tmp_path):
    report = {"Sent Status": spark.range(3), "Unsent": spark.range(2)}
    reports.write_report(report, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert {r["section"]: r["count"] for r in back.groupBy("section").count().collect()} == {"Sent Status": 3, "Unsent": 2}
    reports.write_report({"a": spark.range(2).orderBy("id")}, str(tmp_path / "c"), "csv", header=False)
    assert lines(tmp_path / "c" / "section=a") == ["0", "1"]


def failing(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no such ward"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_section_that_fails_leaves_the_old_report(spark, tmp_path):
    path = str(tmp_path / "r")
    reports.write_report({"a": spark.range(3), "b": spark.range(2)}, path)
    with pytest.raises(Exception, match="no such ward"):
        reports.write_report({"a": spark.range(30), "b": failing(spark)}, path)
    back = spark.read.parquet(path)
    assert {r["section"]: r["count"] for r in back.groupBy("section").count().collect()} == {"a": 3, "b": 2}
    reports.write_report({"a": spark.range(4)}, path)
    assert {r["section"]: r["count"] for r in spark.read.parquet(path).groupBy("section").count().collect()} == {"a": 4, "b": 2}


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_a_published_report_is_seen_as_a_whole(spark, tmp_path, file_format):
    path = str(tmp_path / "p")
    assert reports.published_sections(spark, path) == {}

    def counts():
        return {name: df.count() for name, df in reports.published_sections(spark, path).items()}

    reports.publish_report({"a": spark.range(3), "b b": spark.range(2)}, path, file_format)
    before = reports.published_sections(spark, path)
    with pytest.raises(Exception, match="no such ward"):
        reports.publish_report({"a": spark.range(30), "b b": failing(spark)}, path, file_format)
    assert counts() == {"a": 3, "b b": 2}
    reports.publish_report({"a": spark.range(5)}, path, file_format)
    assert counts() == {"a": 5}
    # A reader that began before goes on.
    assert before["a"].count() == 3
    reports.publish_report({"a": spark.range(6)}, path, file_format)
    assert counts() == {"a": 6}
    assert len(list((tmp_path / "p" / "manifests").glob("[0-9]*"))) == 2


def test_sections_in_one_pass(spark, tmp_path):
    df = spark.range(100).withColumn("section", F.when(F.col("id") < 70, "big").otherwise("small"))
    reports.write_sections(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {r["section"]: r["count"] for r in back.groupBy("section").count().collect()} == {"big": 70, "small": 30}


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, True, None), (2, 3.5, False, "x")], "id int, amount double, flag boolean, s string").orderBy("id")
    reports.write_delimited(df, str(tmp_path / "pipe"), sep="|", no_decimals=True)
    assert [x for x in lines(tmp_path / "pipe") if x != "id|amount|flag|s"] == ["1|2|True|", "2|4|False|x"]
    reports.write_delimited(df.coalesce(1), str(tmp_path / "bare"), sep="|", header=False)
    assert lines(tmp_path / "bare") == ["1|2.5|True|", "2|3.5|False|x"]
    reports.write_delimited(df.coalesce(1), str(tmp_path / "named"), names=["Id", "Amount", "Is It", "Text"])
    assert lines(tmp_path / "named")[0] == "Id,Amount,Is It,Text"


def test_text_report(spark, tmp_path):
    beds = [("PCU", "2", "A", "B, C", 12), ("CCU", "1", "B", "D, E", 7)]
    df = spark.createDataFrame(beds, "nurst string, room string, bed string, pname string, patno long")
    title = reports.missing_orders_title(date(2024, 1, 20))
    reports.write_text_report(df, title, reports.MISSING_ORDERS_GAPS, ["nurst"], str(tmp_path / "t"))
    got = lines(tmp_path / "t")
    assert got[: len(title)] == title
    assert got[len(title) :] == [
        "CCU      1         B     D, E             7",
        "PCU      2         A     B, C             12",
    ]


def test_audit(spark, tmp_path):
    reports.write_audit(spark.range(1), spark.range(4), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a/main")).count() == 4
    assert spark.read.parquet(str(tmp_path / "a/audit")).count() == 1


def test_names():
    assert reports.dated("out/census", date(2024, 1, 20)) == "out/census-2024-01-20"
    assert reports.stamped("BED.", datetime(2024, 3, 4, 5, 6, 7)) == "BED.20240403050607"
