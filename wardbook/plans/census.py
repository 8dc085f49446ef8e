"""Bed censuses, admissions and discharges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import on_day, same_day, since
from wardbook.functions.predicates import any_of, occupied
from wardbook.operators.joins import Facts, Look, equi_join, meet
from wardbook.operators.shape import contract, ordered, spaced
from wardbook.plans import settings as S
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables


def taken_beds(t: Tables) -> DataFrame:
    """Beds with a patient in them; empty beds all share patient number 0."""
    return t.rmbed.where(occupied("pat_no"))


def house_census(t: Tables, as_of: date, p: Params) -> DataFrame:
    beds = taken_beds(t).where(~F.col("nurst").isin(S.CENSUS_SKIPPED_UNITS))
    patients = t.patients.select("patno", "pname", "age", "diagn", "nwdocnum")
    found = Facts(beds).by("pat_no", Look(patients, "patno")).code("nwdocnum", t.phymast, "nwdrnum").df
    return ordered(contract(found, ["nurst", "room", "bed", "observ", "pname", "age", "diagn", "phname"]), "nurst")


def admissions(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Yesterday's admissions that are on a station, marked inpatient or OBS."""
    admitted = t.patients.where(on_day("isadate", as_of, 1)).select("hssvc", "patno", "pname", "isadate")
    placed = taken_beds(t).where(F.col("nurst") != "NULL")
    found = meet(placed, "pat_no", admitted.withColumn("_p", F.col("patno")), "_p")
    section = F.when(F.col("hssvc") == S.OBSERVATION, "OBS").when(F.col("hssvc") != S.OBSERVATION, "inpatient")
    found = found.withColumn("section", section).where(F.col("section").isNotNull())
    return ordered(
        contract(found, ["section", "hssvc", "patno", "pname", "isadate", "room", "bed", "nurst"]), "section", "hssvc"
    )


def unit_census(t: Tables, as_of: date, p: Params, unit: str = S.CCU) -> DataFrame:
    """One unit's beds, each followed by two blank lines to write on."""
    beds = taken_beds(t).where(F.col("nurst") == unit)
    patients = t.patients.select("patno", "pname", "diagn")
    found = Facts(beds).by("pat_no", Look(patients, "patno")).df
    return spaced(contract(found, ["room", "bed", "pat_no", "pname", "diagn"]), 2)


def unit_census_lines(t: Tables, as_of: date, p: Params) -> DataFrame:
    lines = unit_census(t, as_of, p)
    return lines.orderBy("_sort", "line").drop("_sort")


def patients_by_service(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Yesterday's patients of one service with their attending physician."""
    admitted = t.only("patients", "hssvc", [S.COMMUNITY_SERVICE]).where(on_day("isadate", as_of, 1))
    found = Facts(admitted).by("nwattphy", Look(t.phymast, "nwdrnum")).df
    return ordered(contract(found, ["patno", "pname", "isadate", "phname"]), "phname")


def observation(t: Tables, as_of: date, p: Params, days: int = 1) -> DataFrame:
    """Observation patients admitted yesterday (1), or in the last `days` days."""
    window = same_day("isadate", as_of, 1) if days == 1 else since("isadate", as_of, days)
    admitted = t.only("patients", "hssvc", [S.OBSERVATION]).where(window)
    registered = t.admreg.select("patno", "hstnum", "atype", "asrce", "arrvd")
    found = Facts(admitted).by(["patno", "hstnum"], Look(registered, ["patno", "hstnum"])).df
    names = "patno adate iatme isqadte iqtime nwdocnum hssvc atype asrce age fincl pname arrvd diagn hstnum"
    return contract(found, names.split())


def expired(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Patients who died yesterday, one row per recorded room."""
    out = t.patients.where(on_day("isddate", as_of, 1))
    dead = equi_join(out, t.dsstat.where(F.col("dcexp") == "Y").drop("dcdsc"), "dcstat", "dcubs", "inner")
    rooms = t.patrmbdp.where(F.col("recid") == "Y").select("patn15", "room", "bed")
    found = meet(rooms, "patn15", dead.withColumn("_p", F.col("patno")), "_p")
    names = "hssvc patno pname age sex isadate iatme diagn isddate dtime dcsds dcexp room bed"
    return ordered(contract(found, names.split()), "pname")


def missing_admit_orders(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Beds whose inpatient has no admit order.

    Each bed comes once; looking each patient up again would list the beds of a
    patient with two of them twice over.
    """
    inpatients = t.only("patients", "hssvc", S.INPATIENT_SERVICES).select("patno", "pname")
    with_order = t.oeorder.where(F.col("oproc").isin(S.ADMIT_ORDERS)).select("opat_no").distinct()
    missing = Facts(taken_beds(t)).by(
        "pat_no", Look(inpatients, "patno", "inner"), Look(with_order, "opat_no", "left_anti")
    ).df
    out = contract(missing, ["nurst", "room", "bed", "pname", ("patno", "pat_no")])
    return ordered(out, "nurst")


# --- clinic doctors' patients -----------------------------------------------------


def _clinic(t: Tables, patients: DataFrame, p: Params) -> DataFrame:
    """Patients whose family doctor is on the clinic's roster, with bed and disposition."""
    doctors = t.pathist.where(F.col("nwfdoc_no").isin(p.clinic_providers)).select("histn", "nwfdoc_no")
    return (
        Facts(patients)
        .by("hstnum", Look(doctors, "histn", "inner"))
        .by("patno", Look(taken_beds(t).select("pat_no", "nurst"), "pat_no"))
        .code("nwfdoc_no", t.phymast, "nwdrnum")
        .code("hssvc", t.stathd, "svccd")
        .code("dcstat", t.dsstat.select("dcubs", "dcdsc"), "dcubs")
        .df
    )


_CLINIC = "pname isdob isadate iatme isddate dcdsc diagn phname".split()


def clinic_emergency(t: Tables, as_of: date, p: Params) -> DataFrame:
    patients = t.only("patients", "hssvc", [S.EMERGENCY]).where(same_day("isadate", as_of, 1))
    return contract(_clinic(t, patients, p), _CLINIC)


def clinic_inpatients(t: Tables, as_of: date, p: Params) -> DataFrame:
    """In a bed on one of the units, or discharged in the last three days."""
    patients = t.only("patients", "hssvc", S.CLINIC_SERVICES)
    in_unit = F.col("nurst").isin(S.CLINIC_UNITS)
    found = _clinic(t, patients, p).where(any_of(in_unit, since("isddate", as_of, 3)))
    return ordered(contract(found, _CLINIC), "phname")


def clinic_report(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    return {"Patients in ER": clinic_emergency(t, as_of, p), "Inpatients": clinic_inpatients(t, as_of, p)}
