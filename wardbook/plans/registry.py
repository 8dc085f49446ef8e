"""Named reports: name -> plan, and a runner over any tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame

from wardbook.plans import billing, census, extracts, notes, nursing, orders, surgery, throughput
from wardbook.plans.settings import Params
from wardbook.sinks.reports import MISSING_ORDERS_GAPS, missing_orders_title, rendered, summary_lines, text_lines
from wardbook.sources.tables import Tables

Report = Callable[[Tables, date, Params], DataFrame]


def missing_admit_text(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The list of missing admit orders as a text report."""
    rows = census.missing_admit_orders(t, as_of, p)
    return text_lines(rows, missing_orders_title(as_of), MISSING_ORDERS_GAPS, ["nurst"])


def virus_summary_text(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The virus summary as 'label: number' lines."""
    return summary_lines(orders.virus_summary(t, as_of, p), orders.SUMMARY_ORDER)


def bed_extract_text(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The bed extract as its delimited file shows it."""
    return rendered(extracts.bed_extract(t, as_of, p))


def radiology_text(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The inpatient revenue list as its delimited file shows it, amounts as floats without decimals."""
    rows = billing.radiology_revenue(t, as_of, p, "Inpatient")
    return rendered(rows.withColumn("amt1", rows["amt1"].cast("double")))


REPORTS: dict[str, Report] = {
    "house_census": census.house_census,
    "admit_split": census.admissions,
    "unit_census_spacers": census.unit_census_lines,
    "patients_by_service": census.patients_by_service,
    "observation_day": partial(census.observation, days=1),
    "observation_week": partial(census.observation, days=7),
    "expired": census.expired,
    "missing_admit_order": census.missing_admit_orders,
    "missing_admit_text": missing_admit_text,
    "billing_demo": billing.demographics,
    "billing_census": billing.billing_census,
    "rad_revenue_ip": partial(billing.radiology_revenue, section="Inpatient"),
    "rad_revenue_text": radiology_text,
    "rad_revenue_op": partial(billing.radiology_revenue, section="Outpatient"),
    "lines_last_day": nursing.central_lines_last_day,
    "infection_foley": nursing.catheters,
    "infection_lines": nursing.central_lines,
    "infection_iso": nursing.isolation_pack,
    "infection_problem": nursing.isolation_problems,
    "infection_mdro": nursing.resistant_organisms,
    "infection_vaccine": nursing.vaccines_not_given,
    "isolation_orders": nursing.isolation_orders,
    "isolation_nutrition": nursing.isolation_nutrition,
    "results_by_code": orders.results_by_code,
    "results_by_code_rows": orders.results_by_code_rows,
    "result_totals": orders.result_totals,
    "ordered_procedures": orders.ordered_procedures,
    "employee_results": orders.employee_results,
    "lab_tat": orders.lab_turnaround,
    "fax_all": orders.fax_log,
    "fax_by_status": orders.fax_by_status,
    "fax_sent": partial(orders.fax_with_status, status="S"),
    "fax_unsent": partial(orders.fax_with_status, status="U"),
    "lab_monitor": orders.lab_monitor,
    "missing_rt": orders.missing_respiratory_orders,
    "virus_summary": orders.virus_summary,
    "virus_summary_text": virus_summary_text,
    "flu_unit_counts": orders.flu_unit_counts,
    "clinic_er": census.clinic_emergency,
    "clinic_or_precedence": census.clinic_inpatients,
    "anti_note_buckets": notes.patients_without_note,
    "audit_matched": notes.patients_with_note,
    "notes_2_days": partial(notes.notes_by_author, days=2),
    "notes_by_prefix": partial(notes.notes_by_author, days=14),
    "notes_rows": notes.notes_rows,
    "notes_32_days": partial(notes.notes_by_author, days=32),
    "notes_45_days": partial(notes.notes_by_author, days=45),
    "notes_plus_transcripts": notes.department_documents,
    "or_log_yesterday": surgery.or_log_yesterday,
    "or_log_mtd": surgery.or_log_month_to_date,
    "or_log_month": surgery.or_log_month,
    "ssi_denominator": surgery.surgical_denominator,
    "surgery_list": surgery.surgery_list,
    "surgery_schedule": surgery.surgery_schedule,
    "surgery_schedule_second": surgery.surgery_schedule_second,
    "schedule_by_date": surgery.schedule_by_date,
    "schedule_by_physician": surgery.schedule_by_physician,
    "bed_feed": extracts.bed_feed,
    "bed_extract": extracts.bed_extract,
    "bed_extract_text": bed_extract_text,
    "ed_extract": extracts.emergency_extract,
    "hospitalist_extract": extracts.hospitalist_extract,
    "throughput_all": throughput.last_moves,
    "throughput_by_move": throughput.by_move_date,
    "throughput_by_station": throughput.by_station,
    "throughput_by_admit": throughput.by_admit_date,
}


# Reports of several sections: a frame with a `section` column where the sections are
# a split of one list (written in one pass), else one frame per section.
PACKS: dict[str, Callable[[Tables, date, Params], DataFrame | dict[str, DataFrame]]] = {
    "admissions": census.admissions,
    "clinic": census.clinic_report,
    "infection": nursing.infection_pack,
    "isolation": nursing.isolation_report,
    "isolation_nutrition": partial(nursing.isolation_report, nutrition=True),
    "results": orders.result_sections,
    "faxes": orders.fax_sections,
    "radiology_revenue": billing.radiology_charges,
    "without_note": notes.patients_without_note,
    "notes_by_author": partial(notes.notes_by_author, days=14),
    "or_log": surgery.or_log,
    "surgery_schedule": surgery.schedule_sections,
    "throughput": throughput.throughput,
}


def run(name: str, tables: Tables, as_of: date, params: Params | None = None) -> DataFrame:
    """Run a named report."""
    return REPORTS[name](tables, as_of, params or Params())


def run_pack(name: str, tables: Tables, as_of: date, params: Params | None = None):
    """Run a report of several sections; `write_report` and `write_sections` take the result."""
    return PACKS[name](tables, as_of, params or Params())
