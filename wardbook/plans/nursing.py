"""Reports on nursing records: lines, catheters, isolation, vaccines, organisms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import between_days, on_day, since, time_after
from wardbook.functions.predicates import any_of, dated, not_discharged, present
from wardbook.functions.text import dash
from wardbook.operators.joins import Facts, Look, meet, sift_to
from wardbook.operators.keep import keep_table
from wardbook.operators.shape import contract, ordered
from wardbook.plans import settings as S
from wardbook.plans.census import taken_beds
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables


def _records(t: Tables, records: DataFrame, units: list[str], patients: DataFrame, how: str = "left") -> DataFrame:
    """Nursing records of active parameters, with the patient's bed on one of the units.

    The records are the facts: every one of these reports filters on them, so
    the outer joins from bed to record are inner joins in effect.
    """
    beds = taken_beds(t).where(F.col("nurst").isin(units)).select("pat_no", "nurst", "room", "bed")
    active = t.ncprm.where(F.col("prsts") == "A").select("prid", "prval", "prds")
    return (
        Facts(records)
        .by("trpat_no", Look(beds, "pat_no", "inner"), Look(patients, "patno", how))
        .code("trprmid", active, "prid", "inner")
        .df.withColumnRenamed("trpat_no", "pat_no")
    )


def _parameter(codes: list[str], window: Column) -> Column:
    return F.col("trprmid").isin(codes) & window


def central_lines_last_day(t: Tables, as_of: date, p: Params) -> DataFrame:
    records = t.nctrn.where(
        _parameter(S.LINE_PARAMETERS_DAILY, since("trrecdt", as_of, 1)) & ~F.col("trrecval").isin(S.LINE_NOT_CENTRAL)
    )
    found = _records(t, records, S.LINE_UNITS, t.patients.select("patno", "isadate", "pname"))
    return contract(found, "nurst room bed isadate pat_no pname trrecdt prval trrecval".split())


def catheters(t: Tables, as_of: date, p: Params) -> DataFrame:
    records = t.nctrn.where(
        _parameter(S.CATHETER_PARAMETERS, between_days("trrecdt", as_of, 1)) & ~F.col("trrecval").isin(S.CATHETER_NOT_ONE)
    )
    found = _records(t, records, S.NURSING_UNITS, t.patients.select("patno", "isadate", "pname"))
    names = ["nurst", ("rb", dash("room", "bed")), *"isadate pat_no pname trrecdt trrecval trcom".split()]
    return ordered(contract(found, names), "nurst", "trrecdt")


def central_lines(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Central lines, or dressing records on the units that keep them, of patients still in."""
    codes = list(dict.fromkeys([*S.LINE_PARAMETERS, *S.LINE_PARAMETERS_DRESSING]))
    units = list(dict.fromkeys([*S.LINE_UNITS, *S.LINE_UNITS_DRESSING]))
    records = t.nctrn.where(_parameter(codes, between_days("trrecdt", as_of, 1)))
    patients = t.patients.where(dated("isadate") & not_discharged("isddate")).select("patno", "isadate", "pname")
    found = _records(t, records, units, patients, "inner")
    central = ~F.col("trrecval").isin(S.LINE_NOT_CENTRAL) & (F.trim("trrecval") != "")
    found = found.where(
        any_of(
            F.col("nurst").isin(S.LINE_UNITS) & F.col("trprmid").isin(S.LINE_PARAMETERS) & central,
            F.col("nurst").isin(S.LINE_UNITS_DRESSING) & F.col("trprmid").isin(S.LINE_PARAMETERS_DRESSING),
        )
    )
    names = ["nurst", ("rb", dash("room", "bed")), *"isadate pat_no pname trrecdt prval trrecval trcom".split()]
    return ordered(contract(found, names), "nurst", "pat_no", "trrecdt")


def _isolation(t: Tables, window: Column, units: list[str]) -> DataFrame:
    records = t.nctrn.where(
        _parameter([S.ISOLATION_PARAMETER], window) & (F.col("trrecval") != S.ISOLATION_STANDARD)
    )
    return _records(t, records, units, t.patients.select("patno", "pname"), "inner")


def _yesterday_evening(as_of: date) -> Column:
    return on_day("trrecdt", as_of, 1) & time_after("trrecdt", S.ISOLATION_AFTER)


def isolation_pack(t: Tables, as_of: date, p: Params) -> DataFrame:
    found = _isolation(t, _yesterday_evening(as_of), S.NURSING_UNITS)
    names = ["nurst", ("rmbed", dash("room", "bed")), "pat_no", "pname", "trrecval", "trrecdt"]
    return ordered(contract(found, names), "nurst", "rmbed")


def isolation_orders(t: Tables, as_of: date, p: Params) -> DataFrame:
    found = _isolation(t, _yesterday_evening(as_of), S.ISOLATION_UNITS)
    names = [*"nurst room bed pat_no pname trrecval trrecdt".split(), ("trrecdt_2", "trrecdt")]
    return ordered(contract(found, names), "nurst", "room", "bed")


def isolation_nutrition(t: Tables, as_of: date, p: Params) -> DataFrame:
    found = _isolation(t, since("trrecdt", as_of), S.ISOLATION_UNITS)
    return ordered(contract(found, "nurst room bed pat_no pname trrecval trrecdt".split()), "nurst", "room", "bed", "trrecdt")


def isolation_problems(t: Tables, as_of: date, p: Params) -> DataFrame:
    answers = t.chpdtaph.where(F.col("dthresp") == S.ISOLATION_RESPONSE).select("dthpatno", "dthresp", "dthdttm")
    beds = taken_beds(t).where(present("nurst")).select("pat_no", "nurst", "room", "bed")
    answers = sift_to(answers, "dthpatno", beds, "pat_no")
    found = Facts(answers).by(
        "dthpatno", Look(beds, "pat_no", "inner"), Look(t.patients.select("patno", "pname"), "patno")
    ).df
    names = "nurst room bed dthpatno pname dthresp dthdttm".split()
    return ordered(contract(found, names), "nurst", "room", "bed")


def resistant_organisms(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Infections of patients discharged yesterday.

    One service code of the source list has a leading blank and never matched;
    the list here holds the code itself.
    """
    left = t.only("patients", "hssvc", S.ORGANISM_SERVICES).where(on_day("isddate", as_of, 1))
    left = left.select("patno", "isddate", "hssvc").withColumn("_p", F.col("patno"))
    found = meet(t.chpdrip, "cipat_no", left, "_p")
    return contract(found, "patno isddate hssvc ciinfctn ciiddte cirecdte ciresdte ciresby cistscd cicmmt".split())


def vaccines_not_given(t: Tables, as_of: date, p: Params) -> DataFrame:
    answer = F.rtrim(F.substring("trrecval", 1, 3))
    records = t.nctrn.where(_parameter(S.VACCINE_PARAMETERS, on_day("trrecdt", as_of, 1)) & answer.isin(S.VACCINE_NOT_GIVEN))
    patients = t.patients.select("patno", F.col("patno").alias("patient"), "pname", "age")
    found = _records(t, records, S.NURSING_UNITS, patients)
    names = ["nurst", "room", "bed", ("patno", "patient"), *"pname age trrecdt prds trrecval trusr".split()]
    return ordered(contract(found, names), "nurst", "room", "bed", "prds")


def _day_of_records(t: Tables, as_of: date) -> Tables:
    """The records since yesterday, with the columns the sections show, and the taken beds: each worked out once."""
    codes = dict.fromkeys(
        [*S.CATHETER_PARAMETERS, *S.LINE_PARAMETERS, *S.LINE_PARAMETERS_DRESSING, S.ISOLATION_PARAMETER, *S.VACCINE_PARAMETERS]
    )
    records = t.nctrn.where(_parameter(list(codes), since("trrecdt", as_of, 1)))
    return t.replaced(nctrn=keep_table(records), rmbed=keep_table(taken_beds(t)))


def infection_pack(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    """Six sections from one reading of the records and one of the beds."""
    t = _day_of_records(t, as_of)
    return {
        "Foley": catheters(t, as_of, p),
        "Central Lines": central_lines(t, as_of, p),
        "Isolation": isolation_pack(t, as_of, p),
        "Isolation-CHP": isolation_problems(t, as_of, p),
        "MDRO": resistant_organisms(t, as_of, p),
        "Vaccine": vaccines_not_given(t, as_of, p),
    }


def isolation_report(t: Tables, as_of: date, p: Params, nutrition: bool = False) -> dict[str, DataFrame]:
    t = _day_of_records(t, as_of)
    if nutrition:
        return {"All Patients": isolation_nutrition(t, as_of, p), "CHP": isolation_problems(t, as_of, p)}
    return {"Nurse Orders": isolation_orders(t, as_of, p), "CHP Locations": isolation_problems(t, as_of, p)}
