"""Orders, results, laboratory and fax lists."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import hhmm_to_time, on_day
from wardbook.functions.predicates import present
from wardbook.functions.text import dash
from wardbook.operators.counts import add_metrics, count_where, metric_rows, non_null_counts, value_counts
from wardbook.operators.dedup import copies, expand_copies
from wardbook.operators.joins import Facts, Look, equi_join, in_roster, join_chain, meet, not_in_roster, sift_to
from wardbook.operators.keep import keep
from wardbook.operators.shape import contract, ordered, sections
from wardbook.plans import settings as S
from wardbook.plans.census import taken_beds
from wardbook.plans.settings import Params, value_list
from wardbook.sources.tables import Tables


def packed_day(as_of: date, back: int = 0) -> int:
    """A day as the order tables hold it: yymmdd as a number."""
    return int((as_of - timedelta(days=back)).strftime("%y%m%d"))


def _beds(t: Tables) -> DataFrame:
    return taken_beds(t).select("pat_no", "nurst", "room", "bed")


def _virus_orders(t: Tables) -> DataFrame:
    """Virus orders per patient."""
    orders = t.oeorder.where(F.col("oproc").isin(S.VIRUS_ORDERS))
    return orders.groupBy("opat_no").agg(F.count(F.lit(1)).alias("copies"), F.min("osdate").alias("first_osdate"))


def _not_excluded(patients: DataFrame, p: Params) -> DataFrame:
    return not_in_roster(patients, value_list(patients.sparkSession, p.excluded_patients, "patno"), "patno")


def _reported(t: Tables, p: Params) -> DataFrame:
    """Results that say something, of the groups reported on."""
    results = t.rd.where(present("rdrs") & ~F.trim("rdrs").isin(S.RESULT_NOT_ONE))
    return in_roster(results, value_list(t.rd.sparkSession, p.result_groups, "rdpf"), "rdpf")


def results_by_code(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Results of patients who have a virus order, one section per result group.

    Results and orders meet on the patient only, so the source lists each result
    once per order. Here a result is one row that carries that number in `copies`
    (expand_copies writes them out), and the first order date to sort by.
    """
    patients = _not_excluded(t.patients.select("patno", "pname", "dob"), p)
    found = Facts(_reported(t, p)).by(
        "rdpt_no", Look(_virus_orders(t), "opat_no", "inner"), Look(patients, "patno", "inner")
    ).df
    names = [("section", "rdpf"), "pname", "dob", "rdisvfdt", "rdrs", "copies", "first_osdate"]
    return ordered(contract(found, names), "section", "first_osdate")


def results_by_code_rows(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The results as the source lists them, once per order."""
    return expand_copies(results_by_code(t, as_of, p)).drop("first_osdate")


def result_totals(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Rows per result in each section, counting every copy.

    Results are counted per patient first, so each patient brings a few rows.
    """
    counted = copies(_reported(t, p), ["rdpt_no", "rdpf", "rdrs"], "n_results")
    found = join_chain(
        counted,
        [
            (_virus_orders(t), "rdpt_no", "opat_no", "inner"),
            (_not_excluded(t.patients.select("patno"), p), "rdpt_no", "patno", "inner"),
        ],
    )
    totals = found.groupBy(F.col("rdpf").alias("section"), "rdrs").agg(F.sum(F.col("n_results") * F.col("copies")).alias("n"))
    return totals.orderBy("section", F.desc("n"), "rdrs")


def result_sections(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    lists = sections(keep(results_by_code(t, as_of, p)), "section", p.result_groups)
    counts = sections(keep(result_totals(t, as_of, p)), "section", p.result_groups)
    return {**lists, **{f"{name} Totals": df for name, df in counts.items()}}


def ordered_procedures(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Virus orders with the patient, the bed and the order's status."""
    orders = t.oeorder.where(F.col("oproc").isin(S.VIRUS_ORDERS))
    patients = _not_excluded(t.patients.select("patno", "hssvc", "pname"), p)
    found = (
        Facts(orders)
        .by("opat_no", Look(patients, "patno", "inner"), Look(_beds(t), "pat_no"))
        .code("ostat", t.oeostat, "stat_no")
        .df
    )
    names = ["oproc", "hssvc", ("patno", "opat_no"), *"pname room bed nurst osdate stdsc oisrdate".split()]
    return ordered(contract(found, names), "osdate")


def employee_results(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Employees' test results on yesterday's orders."""
    results = t.rd.where(F.col("rdts") == S.EMPLOYEE_TEST).select("rdpt_no", "rdor_no", "rdts", "rdrs")
    orders = t.oeorder.where((F.col("optlst") == p.site_code) & (F.col("osdate") == packed_day(as_of, 1)))
    orders = orders.select("opat_no", "oord_no", "osdate")
    accounts = t.indaccum.select("iapnam", "iahst_no", "iaord_no", "iaacct")
    results = sift_to(results, ["rdpt_no", "rdor_no"], orders, ["opat_no", "oord_no"])
    found = (
        Facts(results)
        .by(
            ["rdpt_no", "rdor_no"],
            Look(orders, ["opat_no", "oord_no"], "inner", short=True),
            Look(accounts, ["iaacct", "iaord_no"], "inner"),
        )
        .code("iahst_no", t.pathist.select("histn", "harcd", "phone"), "histn")
        .df
    )
    return ordered(contract(found, "iapnam harcd phone rdts rdrs osdate".split()), "osdate")


def lab_turnaround(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Today's early orders with the times of each step."""
    orders = t.oeorder.where(
        (F.col("osdate") == packed_day(as_of)) & (F.col("ostime") <= 400) & (F.col("otodpt") != S.RADIOLOGY)
    ).select("opty", "oproc", "opat_no", "oord_no", "osdate", "ostime")
    orders = equi_join(orders, taken_beds(t).select("pat_no", "nurst"), "opat_no", "pat_no")
    orders = orders.withColumns({"_pat": F.col("opat_no"), "_ord": F.col("oord_no")})
    found = meet(t.rh, ["rhpt_no", "rhor_no"], orders, ["_pat", "_ord"])
    names = [
        *"opty oproc nurst oord_no opat_no osdate".split(),
        ("stime", hhmm_to_time("ostime")),
        "rhiscldt",
        ("ctime", hhmm_to_time("rhcltm")),
        "rhtc",
        "rhisrndt",
        ("rtime", hhmm_to_time("rhrntm")),
        "rhisvfdt",
        ("vtime", hhmm_to_time("rhvftm")),
        "rhrcby",
    ]
    return ordered(contract(found, names), "nurst", "stime")


def fax_log(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Yesterday's faxes of laboratory orders."""
    faxes = t.rrfaxlog.where(on_day("flidt", as_of, 1))
    orders = t.oeorder.where(F.col("otodpt") == S.LAB).select("opat_no", "oord_no", "oproc")
    found = (
        Facts(faxes)
        .by(["flpt_no", "flor_no"], Look(orders, ["opat_no", "oord_no"], "inner"))
        .by("flpt_no", Look(t.patients.select("patno", "pname"), "patno"))
        .code("oproc", t.oeproc, "pproc")
        .df
    )
    names = ["flpt_no", "pname", "flor_no", "povdsc", "flrcpt", "flsphne", "flstat", ("date", "flidt"), "flitm"]
    return contract(found, names)


def fax_by_status(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Faxes per status, counted per order before orders and faxes meet."""
    faxes = copies(t.rrfaxlog.where(on_day("flidt", as_of, 1)), ["flpt_no", "flor_no", "flstat"], "n_faxes")
    orders = copies(t.oeorder.where(F.col("otodpt") == S.LAB), ["opat_no", "oord_no"], "n_orders")
    key = ["flpt_no", "flor_no"]
    found = Facts(faxes, row_key=[*key, "flstat"]).by(key, Look(orders, ["opat_no", "oord_no"], "inner")).df
    return value_counts(found.withColumn("n_rows", F.col("n_faxes") * F.col("n_orders")), "flstat", weight="n_rows")


def fax_with_status(t: Tables, as_of: date, p: Params, status: str) -> DataFrame:
    return ordered(fax_log(t, as_of, p).where(F.col("flstat") == status), "date")


def fax_sections(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    log = keep(fax_log(t, as_of, p))
    return {
        "Total by Status": value_counts(log, "flstat"),
        "Sent Status": ordered(log.where(F.col("flstat") == "S"), "date"),
        "Unsent Status": ordered(log.where(F.col("flstat") == "U"), "date"),
        "Patient Data": ordered(log, "date"),
    }


def lab_monitor(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Open laboratory orders since yesterday."""
    orders = t.oeorder.where(
        (F.col("osdate") >= packed_day(as_of, 1)) & (F.col("otodpt") == S.LAB) & (F.col("orflag") != "1")
    )
    steps = t.rh.select("rhpt_no", "rhor_no", "rhiscldt", "rhcltm", "rhisrcdt", "rhrctm")
    patients = t.patients.select("patno", F.col("patno").alias("patient"), "pname")
    found = (
        Facts(orders)
        .by(["opat_no", "oord_no"], Look(steps, ["rhpt_no", "rhor_no"]), Look(t.rmtor, ["rmpt_no", "rmor_no"]))
        .by("opat_no", Look(patients, "patno"), Look(_beds(t), "pat_no"))
        .code("oproc", t.oeproc, "pproc")
        .code("ostat", t.oeostat, "stat_no")
        .df
    )
    known = F.col("patient").isNotNull()
    names = [
        ("acc", "rmxrf"),
        ("status", "stdsc"),
        ("test", "povdsc"),
        ("p", "orflag"),
        *"rhiscldt rhcltm rhisrcdt rhrctm".split(),
        ("name", "pname"),
        ("patno", "patient"),
        *[(c, F.when(known, F.col(c))) for c in ("nurst", "room", "bed")],
    ]
    return ordered(contract(found, names), "nurst")


def missing_respiratory_orders(t: Tables, as_of: date, p: Params) -> DataFrame:
    orders = t.oeorder.where(
        F.col("oproc").isin(S.RESPIRATORY_ORDERS) & (F.col("ostat") == S.PENDING_STATUS) & (F.col("oinit") != "Y")
    )
    beds = _beds(t).where(F.col("nurst").isin(S.NURSING_UNITS))
    patients = t.patients.select("patno", "pname")
    found = (
        Facts(orders)
        .by("opat_no", Look(beds, "pat_no", "inner"), Look(patients, "patno", "inner"))
        .code("oproc", t.oeproc, "pproc")
        .df
    )
    names = ["nurst", ("rb", dash("room", "bed")), ("patno", "opat_no"), *"pname osdate ostime oord_no oproc povdsc".split()]
    return ordered(contract(found, names), "nurst", "rb")


# --- state virus summary ---------------------------------------------------------


def _in_house(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Positive results of virus orders with the patient, the bed and the order's status.

    A row stands for `n` rows of the source join: results and orders are counted
    before they meet, and again per patient before beds and patients are joined,
    so a patient with very many of them brings a few rows only.
    """
    orders = t.oeorder.where(F.col("oproc").isin([S.FLU_ORDER, *S.VIRUS_ORDERS]))
    orders = copies(orders, ["opat_no", "oord_no", "oproc", "osdate", "ostat"], "n_orders")
    positive = t.only("rd", "rdrs", [S.POSITIVE], [S.POSITIVE_VIRUS_PREFIX])
    positive = copies(positive, ["rdpt_no", "rdor_no", "rdrs"], "n_results")
    rows = equi_join(positive, orders, ["rdpt_no", "rdor_no"], ["opat_no", "oord_no"], "inner")
    rows = rows.groupBy("rdpt_no", "oproc", "osdate", "ostat", "rdrs").agg(
        F.sum(F.col("n_results") * F.col("n_orders")).alias("n")
    )
    patients = t.patients.select("patno", F.col("patno").alias("patient"), "pname", "hssvc", "isadate")
    return join_chain(
        rows,
        [(patients, "rdpt_no", "patno"), (_beds(t), "rdpt_no", "pat_no"), (t.oeostat, "ostat", "stat_no")],
    )


def _flu_on_unit() -> Column:
    return (
        (F.col("oproc") == S.FLU_ORDER)
        & (F.col("rdrs") == S.POSITIVE)
        & (F.col("hssvc") != S.EMERGENCY)
        & (F.col("stdsc") != S.CANCELLED)
        & (F.col("nurst") != "NULL")
    )


def flu_unit_counts(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Non-NULL values per column among the flu rows on the critical care unit."""
    rows = _in_house(t, as_of, p).where(_flu_on_unit() & (F.col("nurst") == S.CCU))
    names = "oproc hssvc patient pname isadate room bed nurst osdate stdsc rdrs n".split()
    return non_null_counts(rows.select(*names), weight="n")


def _expired(t: Tables) -> DataFrame:
    return t.dsstat.where(F.col("dcexp") == "Y").select("dcubs")


def _left_dead(as_of: date) -> Column:
    """Left a ward yesterday; whether the patient had died is the discharge code's to say (`_expired`)."""
    return F.col("hssvc").isin(S.DEATH_SERVICES) & on_day("isddate", as_of, 1)


def _factors(t: Tables, p: Params) -> DataFrame:
    """Per patient: the pairs of virus orders and positive results of each kind, and whether there is any of either.

    Orders and results are read once each: what counts of a row stands in 0/1 columns, which are summed per patient and
    order number and multiplied there, so the pairs are never written out.
    """
    orders = t.oeorder.where(F.col("oproc").isin([S.FLU_ORDER, *S.VIRUS_ORDERS])).select("opat_no", "oord_no", "oproc", "osdate", "ostat")
    orders = equi_join(orders, t.oeostat, "ostat", "stat_no")
    flu, going_on = F.col("oproc") == S.FLU_ORDER, F.col("stdsc") != S.CANCELLED
    of_order = {
        "flu": flu,
        "flu_on": flu & going_on,
        "flu_season": flu & going_on & (F.col("osdate") >= packed_day(p.flu_season_start)),
        "virus": F.col("oproc").isin(S.VIRUS_ORDERS),
    }
    results = t.only("rd", "rdrs", [S.POSITIVE], [S.POSITIVE_VIRUS_PREFIX])
    of_result = {"positive": F.col("rdrs") == S.POSITIVE, "positive_virus": F.col("rdrs").startswith(S.POSITIVE_VIRUS_PREFIX)}

    def marked(rows: DataFrame, patient: str, order: str, marks: dict[str, Column]) -> DataFrame:
        columns = {name: F.coalesce(marks[name].cast("long"), F.lit(0)) if name in marks else F.lit(0).cast("long") for name in [*of_order, *of_result]}
        return rows.where(F.col(patient).isNotNull()).select(F.col(patient).alias("patno"), F.col(order).alias("order_no"), *[c.alias(n) for n, c in columns.items()])

    both = marked(orders, "opat_no", "oord_no", of_order).unionByName(marked(results, "rdpt_no", "rdor_no", of_result))
    summed = both.groupBy("patno", "order_no").agg(*[F.sum(c).alias(c) for c in [*of_order, *of_result]])
    pairs = {
        "n_flu_any": F.col("flu") * F.col("positive"),
        "n_flu": F.col("flu_on") * F.col("positive"),
        "n_flu_season": F.col("flu_season") * F.col("positive"),
        "n_virus": F.col("virus") * F.col("positive_virus"),
    }
    same_order = F.col("order_no").isNotNull()
    return summed.groupBy("patno").agg(
        *[F.sum(F.when(same_order, n).otherwise(0)).alias(name) for name, n in pairs.items()],
        (F.max("virus") > 0).alias("tested"),
        (F.max("positive_virus") > 0).alias("found"),
    )


# Fixed value: the lines of the summary and the counts that go into each.
_SUMMARY = {
    "flu": ["Total Flu Positives", "Total Covid and Flu Patients"],
    "flu_admits": ["Flu Admits Yesterday"],
    "flu_icu": ["ICU Patients with Flu"],
    "virus": ["Total Covid and Flu Patients"],
    "flu_deaths": ["Deaths Yesterday with Positive Flu Test", "Deaths Yesterday with Positive Flu or Covid Test"],
    "virus_deaths": ["Deaths Yesterday with Positive Flu or Covid Test"],
}


# Fixed value: the order of the lines.
SUMMARY_ORDER = [
    "Total Flu Positives",
    "Flu Admits Yesterday",
    "ICU Patients with Flu",
    "Total Covid and Flu Patients",
    "Deaths Yesterday with Positive Flu Test",
    "Deaths Yesterday with Positive Flu or Covid Test",
]


def virus_summary(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The six numbers of the state summary as (metric, value) rows.

    A row below stands for a patient in a bed (or in none). What the source joins to it, orders and results and, for
    the dead, rooms held, is a factor of its counts.
    """
    patients = t.patients.select("patno", F.col("patno").alias("patient"), "hssvc", "isadate", "isddate", "dcstat")
    dead = equi_join(patients.where(_left_dead(as_of)), _expired(t), "dcstat", "dcubs", "left_semi")
    rooms = copies(sift_to(t.patrmbdp, "patn15", dead, "patient"), "patn15", "n_rooms")
    expired = _expired(t).distinct().withColumn("expired", F.lit(True))
    rows = join_chain(
        _factors(t, p),
        [(patients, "patno", "patno"), (_beds(t).select("pat_no", "nurst"), "patno", "pat_no"), (expired, "dcstat", "dcubs"), (rooms, "patno", "patn15")],
    )
    on_unit = (F.col("hssvc") != S.EMERGENCY) & (F.col("nurst") != "NULL")
    known = F.col("patient").isNotNull() & ~F.col("patient").isin(p.excluded_patients) & present("nurst")
    died = F.col("expired") & _left_dead(as_of)
    of_dead = F.col("n_flu_any") * F.coalesce("n_rooms", F.lit(1))
    counts = rows.agg(
        count_where(on_unit, "n_flu").alias("flu"),
        count_where(on_unit & on_day("isadate", as_of, 1), "n_flu").alias("flu_admits"),
        count_where(F.col("nurst") == S.CCU, "n_flu_season").alias("flu_icu"),
        count_where(known, "n_virus").alias("virus"),
        F.coalesce(F.sum(F.when(died, of_dead)), F.lit(0)).alias("flu_deaths"),
        F.countDistinct(F.when(died & F.col("tested") & F.col("found"), F.col("patno"))).alias("virus_deaths"),
    )
    return add_metrics(metric_rows(counts, _SUMMARY))
