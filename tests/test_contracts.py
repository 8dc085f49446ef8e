"""Output layouts, column by column."""

from __future__ import annotations

import pytest

from wardbook.plans.registry import run
from wardbook.sources.standins import AS_OF

CONTRACTS = {
    "bed_extract": "TimeStamp System Facility FacilityID Unit Room Bed BedType LevelofCareGroup isActive isOccupied isBlocked "
    "PatientCOVIDStatus isPatientLevelCareICU PatientAdmitDate patientAge",
    "ed_extract": "TimeStamp RegistrationTimeStamp System Facility FacilityID isPatientBoarding PatientCOVIDStatus patientAge",
    "observation_day": "patno adate iatme isqadte iqtime nwdocnum hssvc atype asrce age fincl pname arrvd diagn hstnum",
    "house_census": "nurst room bed observ pname age diagn phname",
    "throughput_all": "patno isadate iatme hssvc room asgdate asgtime nurst",
    "lab_monitor": "acc status test p rhiscldt rhcltm rhisrcdt rhrctm name patno nurst room bed",
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_columns_in_order(tables, name):
    assert run(name, tables, AS_OF).columns == CONTRACTS[name].split()


@pytest.mark.parametrize(("name", "width"), [("hospitalist_extract", 40), ("ssi_denominator", 26), ("or_log_month", 12), ("bed_feed", 9), ("billing_demo", 69)])
def test_width(tables, name, width):
    df = run(name, tables, AS_OF)
    assert len(df.columns) == len(set(df.columns)) == width


def test_sorted_reports_come_out_sorted(tables):
    stations = [r["nurst"] for r in run("house_census", tables, AS_OF).collect()]
    assert stations == sorted(stations)
    revenue = [(r["hssvc"], r["ispdatea"], r["pname"]) for r in run("rad_revenue_ip", tables, AS_OF).collect()]
    assert revenue == sorted(revenue)
    lines = [r["value"] for r in run("missing_admit_text", tables, AS_OF).collect()]
    assert lines[0].startswith("MISSING ADMIT ORDERS") and lines[5] == ""
    labels = [r["value"].split(":")[0] for r in run("virus_summary_text", tables, AS_OF).collect()]
    assert labels[0] == "Total Flu Positives" and len(labels) == 6


def test_spacer_rows_follow_their_bed(tables):
    lines = run("unit_census_spacers", tables, AS_OF).collect()
    assert [r["line"] for r in lines[:6]] == [0, 1, 2, 0, 1, 2]
    beds = [(r["room"], r["bed"]) for r in lines if r["line"] == 0]
    assert beds == sorted(beds)
