"""Operating-room logs, surgery lists and schedules, surgical-site denominator."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import duration_parts, month_end, month_start, on_day, us_date
from wardbook.functions.codes import map_codes
from wardbook.functions.text import to_long
from wardbook.operators.counts import value_counts
from wardbook.operators.dedup import copies, first_of_scan, one_per_key, single
from wardbook.operators.joins import Facts, Look, equi_join, sift_all, sift_to, with_details
from wardbook.operators.keep import keep, keep_table
from wardbook.operators.prefixes import keyword_filter, prefix_join
from wardbook.operators.shape import contract, ordered
from wardbook.plans import settings as S
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables

_START = "actcase_start_datetime"


# --- operating-room logs -----------------------------------------------------------


def _first_cases(t: Tables, window: Column) -> DataFrame:
    """The first case of each account in the window with its first procedure.

    First by start time, then by the remaining columns. Accounts are cut to one
    case, and cases to one procedure, before anything is joined.
    """
    cases = t.casemain.where(window)
    first = first_of_scan(cases, "pat_acct_num", [_START, "casemain_id"])
    procedures = sift_to(t.casepro, "casemain_id", first, "casemain_id").select("casemain_id", "actual_proname", "primpract_res_name")
    procedure = one_per_key(procedures, "casemain_id", ["actual_proname", "primpract_res_name"])
    return (
        Facts(first, row_key=["casemain_id"])
        .by(
            "casemain_id",
            Look(procedure, "casemain_id"),
            Look(t.caseintraop, "casemain_id"),
            Look(t.casepreop, "casemain_id"),
        )
        .code("actualroom_res_id", t.psmresindroom, "res_id")
        .code("pattype_id", t.psmpattype, "pattype_id")
        .df
    )


_LOG = [
    *f"{_START} pat_acct_num pat_mrn pat_displayname birthdate abbr".split(),
    *"pat_or_in_datetime pat_or_out_datetime primpract_res_name procedure".split(),
]


def _log(found: DataFrame, names: list) -> DataFrame:
    found = found.withColumns(
        {"birthdate": F.col("pat_birth_datetime").cast("date"), "procedure": F.col("actual_proname")}
    )
    return contract(found, names)


def or_log_yesterday(t: Tables, as_of: date, p: Params) -> DataFrame:
    found = _first_cases(t, on_day(_START, as_of, 1))
    return _log(found, [*_LOG, "schedcase_start_datetime", "schedcase_stop_datetime"])


def or_log_month_to_date(t: Tables, as_of: date, p: Params) -> DataFrame:
    window = (F.col(_START) >= F.lit(as_of.replace(day=1))) & (F.col(_START) < F.lit(as_of))
    return _log(_first_cases(t, window), _LOG)


def or_log(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    """Both sections from one reading of the month's cases and of what was done and noted in them."""
    start = F.col(_START)
    since = min(as_of.replace(day=1), as_of - timedelta(days=1))
    cases = keep_table(t.casemain.where((start >= F.lit(since)) & (start < F.lit(as_of))))
    parts = ("casepro", "caseintraop", "casepreop")
    cut = sift_all([(t[name], "casemain_id") for name in parts], cases, "casemain_id")
    t = t.replaced(casemain=cases, **{name: keep_table(df) for name, df in zip(parts, cut, strict=True)})
    return {"Yesterday": or_log_yesterday(t, as_of, p), "MTD": or_log_month_to_date(t, as_of, p)}


def or_log_month(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Cases from the start of last month to yesterday, with room names."""
    window = (F.col(_START) >= month_start(as_of, 1)) & (F.col(_START) < F.lit(as_of))
    found = _first_cases(t, window)
    room = map_codes("actualroom_res_abbr", S.ROOM_NAMES)
    names = [
        *f"casemain_id pat_acct_num pat_lastname primpract_res_name pat_or_in_datetime {_START}".split(),
        *"actcase_stop_datetime pat_or_out_datetime schedcase_start_datetime schedcase_stop_datetime".split(),
        ("Room Name", room),
        ("Procedure", "actual_proname"),
    ]
    return ordered(contract(found, names), _START, nulls="first")


# --- surgery list and schedule -------------------------------------------------------


def surgery_list(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Cases scheduled from today to midnight tomorrow for a roster of surgeons."""
    start = F.col("schedcase_start_datetime")
    # BETWEEN a day and the next: the upper bound is that midnight itself.
    cases = t.casemain.where((start >= F.lit(as_of)) & (start <= F.lit(as_of + timedelta(days=1))))
    cases = prefix_join(cases, p.surgeons, "attending_res_name", keep="exists")
    found = with_details(cases, t.casepro.select("casemain_id", "actual_proname"), "casemain_id", "casemain_id")
    names = ["Account Number", "Patient Name", "Physician Name", "Scheduled Date", "Procedure"]
    columns = ["pat_acct_num", "pat_legalname", "attending_res_name", "schedcase_start_datetime", F.substring("actual_proname", 1, 50)]
    return ordered(contract(found, list(zip(names, columns))), "Scheduled Date", nulls="first")


def _bookings(t: Tables, as_of: date, surgeons: list[str], *of_appointment: Look) -> DataFrame:
    """Bookings of the next 35 days with patient, status and physician, not cancelled.

    The visit is joined by its own number, counted first: it brings no column in, but a booking is listed once for each.
    Appointments with several procedures or resources are handled by the callers.
    """
    start = F.col("start_datetime")
    bookings = t.patbooking.where((start >= F.lit(as_of)) & (start < F.lit(as_of + timedelta(days=36))))
    physicians = prefix_join(t.res, surgeons, "name", keep="exists").withColumnRenamed("name", "physician")
    live = equi_join(t.appt, t.apptstatus, "apptstatus_id", "apptstatus_id", "left_semi")
    live = live.where(F.col("apptstatus_id") != S.CANCELLED_APPOINTMENT)
    live = equi_join(live, t.service, "service_id", "service_id").select("appt_id")
    # From the bookings through the list of links to the visits they ask for, before either is grouped.
    links = sift_to(t.visitapptlist, "appt_id", bookings, "appt_id")
    visit = sift_to(t.visit, "visit_id", links, "visit_id")
    visits = equi_join(links, copies(visit, "visit_id", "n_visits"), "visit_id", "visit_id")
    visits = visits.groupBy("appt_id").agg(F.sum(F.coalesce("n_visits", F.lit(1))).alias("n_visits"))
    return (
        Facts(bookings)
        .by("pat_id", Look(t.pat, "pat_id"), Look(t.patmrnlist, "pat_id"))
        .by("ordering_phys_id", Look(physicians, "res_id", "inner", short=True))
        .by("appt_id", Look(visits, "appt_id", "inner"), Look(live, "appt_id", "inner"), *of_appointment)
        .code("apptclass_id", t.apptclass, "apptclass_id")
        .df.withColumn("startdate", start.cast("date"))
    )


def surgery_schedule(t: Tables, as_of: date, p: Params, surgeons: list[str] | None = None) -> DataFrame:
    """The last booking of each record number: by date, then by the other columns."""
    names = one_per_key(t.probooking.select("appt_id", "name"), "appt_id", ["name"], "last")
    bookings = _bookings(t, as_of, surgeons or p.surgeons, Look(names, "appt_id"))
    bookings = bookings.select("startdate", "name_legal", "mrn", "physician", "appt_id", "name")
    last = one_per_key(bookings, "mrn", ["startdate", "name_legal", "physician", "appt_id", "name"], "last")
    out = ["startdate", "name_legal", "mrn", ("surgeryname", "name"), "physician"]
    return ordered(contract(last, out), "startdate", nulls="first")


def surgery_schedule_second(t: Tables, as_of: date, p: Params) -> DataFrame:
    return surgery_schedule(t, as_of, p, p.surgeons_second)


def _booking_rows(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Bookings with the number of rows the source join makes of each (procedures x resources)."""
    found = _bookings(
        t,
        as_of,
        p.surgeons,
        Look(copies(t.probooking, "appt_id", "n_procedures"), "appt_id"),
        Look(copies(t.resbooking, "appt_id", "n_resources"), "appt_id"),
    )
    rows = F.col("n_visits") * F.coalesce("n_procedures", F.lit(1)) * F.coalesce("n_resources", F.lit(1))
    return found.select("startdate", "physician", rows.alias("n_rows"))


def schedule_by_date(t: Tables, as_of: date, p: Params) -> DataFrame:
    return value_counts(_booking_rows(t, as_of, p), "startdate", weight="n_rows", order=False)


def schedule_by_physician(t: Tables, as_of: date, p: Params) -> DataFrame:
    return value_counts(_booking_rows(t, as_of, p), "physician", weight="n_rows")


def schedule_sections(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    rows = keep(_booking_rows(t, as_of, p))
    return {
        "Schedule": surgery_schedule(t, as_of, p),
        "Neuro": surgery_schedule_second(t, as_of, p),
        "Total by Date": value_counts(rows, "startdate", weight="n_rows", order=False),
        "Total By Doctor": value_counts(rows, "physician", weight="n_rows"),
    }


# --- surgical-site denominator ----------------------------------------------------------


def _latest_answers(answers: DataFrame, names: dict[str, str]) -> DataFrame:
    """The latest answer of each field per patient, all fields in one pass; ties go to the larger answer."""
    rows = answers.select("dthpatno", "dthfield", "dthdttm", F.trim("dthresp").alias("answer"))
    latest = first_of_scan(rows, ["dthpatno", "dthfield"], ["dthdttm", "answer"], "last")
    # One entry per field, so a list is never longer than `names`.
    by_field = latest.groupBy("dthpatno").agg(F.map_from_entries(F.collect_list(F.struct("dthfield", "answer"))).alias("by_field"))
    return by_field.select("dthpatno", *[F.element_at("by_field", F.lit(field)).alias(name) for field, name in names.items()])


def surgical_denominator(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Cases of the watched procedures over 15 months, with facts from the other source.

    Where a patient has several answers the latest one counts (policies: the
    highest sequence number).
    """
    start = F.col(_START)
    cases = t.casemain.where((start >= month_start(as_of, 15)) & (start <= month_end(as_of, 16)))
    cases = cases.select(
        "casemain_id", "pat_acct_num", "pat_displayname", "pat_gender", "pat_birth_datetime", _START, "actcase_stop_datetime"
    ).withColumn("patno", to_long("pat_acct_num"))
    # Policies are cut to the cases' patients before their two tables are joined; the other histories are cut by the lookup.
    answers = t.chpdtaph.where(F.col("dthfield").isin("Height", "Weight"))
    replies = t.nctrn.where(F.col("trprmid") == S.DIABETES_PARAMETER)
    benefits, extensions = sift_all([(t.benefits, "patno"), (t.benext, "patno")], cases, "patno")
    policies = benefits.select("patno", "seqno", F.trim("policy").alias("medicareid"))
    medicare = extensions.where(F.col("ibinam") == S.MEDICARE).select("patno", "seqno")
    policies = equi_join(policies, medicare, ["patno", "seqno"], ["patno", "seqno"], "left_semi")
    reply = F.when(F.trim("trrecval").isin(S.DIABETES_YES), "Y").otherwise("N")
    diabetes = replies.select("trpat_no", "trrecdt", reply.alias("diabetes"))
    same_day = F.when(F.col("isadate") == F.col("isddate"), "Y").otherwise("N")
    stays = t.patients.select("patno", "isadate", same_day.alias("outpatient"))
    # The lookups are made per case, before the procedures multiply the rows; one
    # spreading of the cases serves all five.
    cases = Facts(cases).by(
        "patno",
        single(policies, "patno", ["medicareid"], ["seqno"]),
        Look(answers, "dthpatno", pick=lambda rows: _latest_answers(rows, {"Height": "height", "Weight": "weight"})),
        single(diabetes, "trpat_no", ["diabetes"], ["trrecdt"]),
        single(stays, "patno", ["outpatient"], ["isadate"]),
    ).df
    procedures = keyword_filter(t.casepro, S.SURGICAL_KEYWORDS, "actual_proname")
    procedures = procedures.select("casemain_id", "actual_proname", "woundclass_id")
    intraop = t.caseintraop.select("casemain_id", "asaclass_id")
    # Both sides of this join are worked out per case already.
    base = Facts(procedures).by("casemain_id", Look(cases, "casemain_id", "inner"), Look(intraop, "casemain_id")).df
    # Answers are looked up through the patient, so without one there is none.
    known = F.col("outpatient").isNotNull()

    hours, minutes = duration_parts(_START, "actcase_stop_datetime")
    empty = F.lit("")
    # Fixed value: the 26 heads of the denominator, in order.
    return contract(
        base,
        [
            ("patid", "pat_acct_num"),
            "medicareid",
            ("patient name", "pat_displayname"),
            ("gender", "pat_gender"),
            ("dob", us_date("pat_birth_datetime")),
            ("height", F.when(known, F.col("height"))),
            ("weight", F.when(known, F.col("weight"))),
            "actual_proname",
            ("proccode", empty),
            ("jntreptype", empty),
            ("jntreptot", empty),
            ("jntrephemi", empty),
            ("jntrepres", empty),
            ("procdate", us_date(_START)),
            "diabetes",
            ("emergency", F.lit("N")),
            ("trauma", F.lit("N")),
            ("asaclass", map_codes("asaclass_id", S.ASA_CLASSES)),
            ("anesthesia", F.lit("Y")),
            ("procdurationhr", hours),
            ("procdurationmin", minutes),
            "outpatient",
            ("scope", F.lit("N")),
            ("swclass", map_codes("woundclass_id", S.WOUND_CLASSES)),
            ("closure", F.lit("Pri")),
            ("infection", empty),
        ],
    )
