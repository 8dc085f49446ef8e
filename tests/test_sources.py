from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardbook.plans.registry import run
from wardbook.sources import schemas
from wardbook.sources.probe import probe_tables
from wardbook.sources.standins import AS_OF
from wardbook.sources.tables import SourceTable, Tables, jdbc_options, load, load_all, snapshot, tidy
from wardbook.sources.text import read_delimited, read_roster, roster


def test_roster_file(spark, tmp_path):
    path = tmp_path / "roster.txt"
    path.write_bytes(b"ADAMS, J   \r\nBAKER\r\n\r\nCLARK \n")
    assert [r["prefix"] for r in read_roster(spark, str(path)).collect()] == ["ADAMS, J", "BAKER", "CLARK"]
    assert [r["provider"] for r in roster(spark, [3, 4], "provider", "long").collect()] == [3, 4]


@pytest.mark.parametrize("sep", [",", "|"])
def test_delimited(spark, tmp_path, sep):
    path = tmp_path / "list.csv"
    path.write_text(f"Room{sep} Bed{sep} Name\n101{sep} A{sep} X\n")
    df = read_delimited(spark, str(path), sep)
    assert df.columns == ["Room", "Bed", "Name"]
    assert tuple(df.first()) == ("101", "A", "X")


def test_tidy_and_snapshot(spark, tmp_path):
    raw = spark.createDataFrame([("CCU ", "101", "A ", Decimal(7), None)], "`NURST` string, ROOM string, BED string, `PAT#` decimal(7,0), OBSERV string")
    assert tidy(raw).columns == ["nurst", "room", "bed", "pat_no", "observ"]
    snapshot(raw, str(tmp_path), "rmbed")
    df = load(spark, str(tmp_path), "rmbed")
    assert df.schema == schemas.schema("rmbed")
    assert tuple(df.first()) == ("CCU", "101", "A", 7, None)
    assert load_all(spark, str(tmp_path)).rmbed.count() == 1


def test_tables_know_their_names(spark, tables):
    assert tables.rmbed is tables["rmbed"]
    assert len(tables) == len(schemas.TABLES) and set(tables) == set(schemas.TABLES)
    with pytest.raises(AttributeError):
        _ = tables.nothing


def test_schema_types():
    kinds = {f.name: f.dataType.simpleString() for f in schemas.schema("accumchg")}
    assert kinds["amt1"] == "decimal(15,2)" and kinds["ispdatea"] == "date" and kinds["patno"] == "bigint"
    assert schemas.padded("rd") == ["rdrs"]


def test_jdbc_read_is_partitioned():
    options = jdbc_options("jdbc:example", "LIB.TABLE", "PATNO", 1, 1000, 16)
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "PATNO" and options["lowerBound"] == "1"


def test_probe(spark, tmp_path):
    beds = [("CCU", "1", "A", n, None) for n in range(20)]
    spark.createDataFrame(beds, schemas.schema("rmbed")).write.parquet(f"{tmp_path}/rmbed.parquet")
    spark.createDataFrame([], "nwdrnum long").write.parquet(f"{tmp_path}/phymast.parquet")
    expected = {name: schemas.columns(name) for name in ("rmbed", "phymast", "patients")}
    found = {r["table_name"]: r for r in probe_tables(spark, str(tmp_path), expected).collect()}
    assert (found["rmbed"]["present"], found["rmbed"]["rows_read"], found["rmbed"]["passed"]) == (True, 5, True)
    assert (found["phymast"]["present"], found["phymast"]["passed"], found["phymast"]["missing_columns"]) == (True, False, "phname")
    assert (found["patients"]["present"], found["patients"]["passed"]) == (False, False)
    assert (found["rmbed"]["readable"], found["rmbed"]["n_columns"], found["patients"]["readable"]) == (True, 5, False)


def test_probe_tells_broken_files(spark, tmp_path):
    """A file cut short, one with broken pages and an absent one are rows, beside a good one."""
    for name in ("good", "short", "pages"):
        spark.range(50_000).selectExpr("id AS a", "uuid() AS b").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        (file,) = (tmp_path / f"{name}.parquet").glob("part-*")
        raw = file.read_bytes()
        if name == "short":
            file.write_bytes(raw[: len(raw) // 2])
        if name == "pages":
            file.write_bytes(raw[:4] + bytes(len(raw) // 2) + raw[4 + len(raw) // 2 :])
        for other in (tmp_path / f"{name}.parquet").glob(".*.crc"):
            other.unlink()
    expected = {name: ["a", "b"] for name in ("good", "short", "pages", "absent")}
    found = {r["table_name"]: (r["present"], r["readable"], r["rows_read"], r["passed"]) for r in probe_tables(spark, str(tmp_path), expected).collect()}
    assert found == {
        "good": (True, True, 5, True),
        "short": (True, False, 0, False),
        "pages": (True, False, 0, False),
        "absent": (False, False, 0, False),
    }


def test_probe_reads_the_expected_columns(spark, tmp_path):
    spark.range(5).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(f"{tmp_path}/t.parquet")
    plan = probe_tables(spark, str(tmp_path), {"t": ["a", "c"]})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint,c:bigint>" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    """Window, list and prefix filters of a report over snapshots are pushed, and few columns are read."""
    from wardbook.functions.clock import on_day
    from wardbook.plans.registry import run

    path = str(tmp_path)
    notes = [(1, "t", date(2024, 1, 19), "DOE", "u", 1)]
    spark.createDataFrame(notes, schemas.schema("cdnotetb")).write.parquet(f"{path}/cdnotetb.parquet")
    records = [(1, "Q0000005455", datetime(2024, 1, 19, 17), "Contact", None, None)]
    spark.createDataFrame(records, schemas.schema("nctrn")).write.parquet(f"{path}/nctrn.parquet")
    for name in ("rmbed", "patients", "ncprm"):
        spark.createDataFrame([], schemas.schema(name)).write.parquet(f"{path}/{name}.parquet")
    t = load_all(spark, path)

    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")

    def scans(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    plan = scans(t.cdnotetb.where(on_day("createdt", date(2024, 1, 20), 1)).select("encid"))
    assert "GreaterThanOrEqual(createdt,2024-01-19)" in plan and "ReadSchema: struct<encid:bigint,createdt:date>" in plan
    plan = scans(run("isolation_orders", t, date(2024, 1, 20)))
    assert "EqualTo(trprmid,Q0000005455)" in plan and "GreaterThanOrEqual(trrecdt,2024-01-19" in plan
    assert "In(nurst, [" in plan and "GreaterThan(pat_no,0)" in plan
    assert "EqualTo(prsts,A)" in plan
    assert "trcom" not in plan.split("ReadSchema")[1]


def test_filters_on_padded_columns_reach_the_source(spark, tmp_path):
    """Equality, IN and prefixes on a CHAR column go to the column as the source has it, padded or not."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    held = ["CCU", "CCU ", "CCU   ", "CCUX", "CC", " CCU", "SSU  ", "", "   ", None, "POSX", "POS SARS 2", "POS"]
    raw = spark.createDataFrame([(i, v, v, v, "o") for i, v in enumerate(held)], "`PAT#` long, NURST string, ROOM string, BED string, OBSERV string")
    raw.write.parquet(str(tmp_path / "raw"))
    t = Tables({"rmbed": SourceTable(spark.read.parquet(str(tmp_path / "raw")), "rmbed")})
    for values, prefixes in ((["CCU"], []), (["CCU", "SSU"], []), ([""], []), ([], ["POS "]), (["CC"], ["POS SARS"]), ([], [])):
        found = t.only("rmbed", "nurst", values, prefixes)
        want = [i for i, v in enumerate(held) if v is not None and (v.rstrip(" ") in values or v.rstrip(" ").startswith(tuple(prefixes)))]
        assert sorted(r["pat_no"] for r in found.collect()) == want, (values, prefixes)
        assert rows(found) == rows(Tables({"rmbed": lambda: t.rmbed}).only("rmbed", "nurst", values, prefixes))
        assert rows(t.replaced(other=raw).only("rmbed", "nurst", values, prefixes)) == rows(found)
    plan = t.only("rmbed", "nurst", ["CCU", "SSU"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "In(NURST, [CCU,SSU])" in pushed and "StringStartsWith(NURST,CCU )" in pushed
    plan = t.only("rmbed", "pat_no", [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "In(`PAT#`, [3,5])" in plan or "In(PAT#, [3,5])" in plan


def test_reports_hand_their_lists_to_the_source(spark, tmp_path, tables):
    """A report over padded source tables: the same rows as over the tidied ones, with its service list pushed."""
    padded = tables.patients.withColumn("hssvc", F.rpad("hssvc", 8, " ")).withColumnsRenamed({"hssvc": "HSSVC"})
    padded.write.parquet(str(tmp_path / "patients"))
    source = SourceTable(spark.read.parquet(str(tmp_path / "patients")), "patients")
    t = Tables({**{name: (lambda name=name: tables[name]) for name in tables}, "patients": source})
    for name in ("missing_admit_order", "patients_by_service"):
        found = run(name, t, AS_OF)
        assert "StringStartsWith(HSSVC," in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(run(name, tables, AS_OF)) != []
