"""Reports of several sections, and what every plan must not do."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from wardbook.plans.registry import PACKS, REPORTS, run, run_pack
from wardbook.sinks.reports import write_report, write_sections
from wardbook.sources.standins import AS_OF


@pytest.mark.parametrize("name", PACKS)
def test_pack_writes_its_sections(spark, tables, tmp_path, name):
    pack = run_pack(name, tables, AS_OF)
    path = str(tmp_path / name)
    if isinstance(pack, dict):
        write_report(pack, path)
        for section, df in pack.items():
            back = spark.read.parquet(f"{path}/section={section}")
            assert set(back.columns) >= set(df.columns) and back.count() == df.count()
    else:
        write_sections(pack, path)
        assert spark.read.parquet(path).count() == pack.count()


def test_sections_of_a_pack_are_the_single_reports(tables):
    pack = run_pack("faxes", tables, AS_OF)
    for section, name in (("Sent Status", "fax_sent"), ("Unsent Status", "fax_unsent"), ("Patient Data", "fax_all")):
        assert pack[section].exceptAll(run(name, tables, AS_OF)).count() == 0
    assert pack["Total by Status"].exceptAll(run("fax_by_status", tables, AS_OF)).count() == 0
    pack = run_pack("throughput", tables, AS_OF)
    assert pack["Total by Move Date"].exceptAll(run("throughput_by_move", tables, AS_OF)).count() == 0


SHARED = {
    "infection": {
        "Foley": "infection_foley", "Central Lines": "infection_lines", "Isolation": "infection_iso",
        "Isolation-CHP": "infection_problem", "MDRO": "infection_mdro", "Vaccine": "infection_vaccine",
    },
    "or_log": {"Yesterday": "or_log_yesterday", "MTD": "or_log_mtd"},
    "isolation": {"Nurse Orders": "isolation_orders", "CHP Locations": "infection_problem"},
}


@pytest.mark.parametrize("name", SHARED)
def test_sections_from_a_shared_base_are_the_single_reports(tables, name):
    pack = run_pack(name, tables, AS_OF)
    for section, report in SHARED[name].items():
        single = run(report, tables, AS_OF)
        assert pack[section].exceptAll(single).count() == single.exceptAll(pack[section]).count() == 0


def test_sections_do_not_read_the_shared_tables_again(tables):
    """Records, beds and cases are written once; a section reads what was written."""
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    pack = run_pack("infection", tables, AS_OF)
    # Stand-in records are events: none of their columns is worked out in a section on records.
    for section in ("Foley", "Central Lines", "Isolation", "Vaccine"):
        assert "event_id" not in scans(pack[section]), section
    for section, df in run_pack("or_log", tables, AS_OF).items():
        assert "l_orderkey" not in scans(df) and "o_orderdate" not in scans(df), section


def test_audit_and_main_output_make_up_the_census(tables):
    matched, unmatched = run("audit_matched", tables, AS_OF), run("anti_note_buckets", tables, AS_OF)
    beds = tables.rmbed.where("pat_no > 0 AND nurst NOT IN ('DIAG', 'NUR', 'WHBC', 'CVPR', 'EOP')")
    assert matched.count() + unmatched.count() == beds.count()
    assert matched.select("pat_no").intersect(unmatched.select("pat_no")).count() == 0


@pytest.mark.parametrize("name", REPORTS)
def test_no_plan_pairs_rows_without_a_key(spark, name):
    plan = entry_points.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Window "):
        assert operator not in plan
