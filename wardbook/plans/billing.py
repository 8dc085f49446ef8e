"""Billing extracts and revenue lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import between_days, on_day
from wardbook.operators.joins import Facts, Look, equi_join, role
from wardbook.operators.keep import keep_table
from wardbook.operators.shape import contract
from wardbook.plans import settings as S
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables

_EXTENSION = ["ibinam", "ibiadr", "ibiad2", "ibicty", "ibstat", "ibarcd", "ibphn1", "ibphn2", "ibizip"]
_HISTORY = ["race", "martl", "ssn", "padr1", "padr2", "hcity", "zip", "harcd", "phone", "c1nam", "c1rel", "c1arc", "c1phn"]


def demographics(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Emergency patients of five days ago with up to three insurances.

    The first and second insurance must be the same on the visit and in the
    history; the third is taken from the history alone, as in the source query.
    """
    visit = t.patients.where(on_day("isadate", as_of, 5))
    emergency = t.admreg.where(F.col("admhsv") == S.EMERGENCY).select("patno")
    history = t.pathist.select("histn", *_HISTORY, *[F.col(f"ains{i}").alias(f"hist_ins{i}") for i in (1, 2, 3)])
    facts = (
        Facts(visit)
        .by("hstnum", Look(history, "histn", "inner"))
        .by("nwattphy", Look(t.phymast, "nwdrnum", "inner"))
        .by("patno", Look(emergency, "patno", "inner"))
        .where(F.col("ains1") == F.col("hist_ins1"))
    )
    base = facts.df
    both = F.when(F.col("ains2") == F.col("hist_ins2"), F.col("ains2"))
    base = base.withColumns({"ins1": F.col("ains1"), "ins2": both, "ins3": F.col("hist_ins3")})
    policies = _policies(*facts.sift("patno", (t.benefits, "patno"), (t.benext, "patno")))
    for i, how in ((1, "inner"), (2, "left"), (3, "left")):
        base = equi_join(base, role(policies, f"_{i}"), ["patno", "hstnum", f"ins{i}"], [f"patno_{i}", f"histn_{i}", f"insco_{i}"], how)
    names = ["patno", "hstnum", "isadate", "isddate", "pname", "isdob", "sex", *_HISTORY, "nwattphy", "phname", "nwrefdoc"]
    names += [("phname_2", "phname"), "diagn", "nwdocnum", ("phname_3", "phname")]
    names += ["ains1", "apln1", "ains2", "apln2", "ains3", "apln3"]
    for i in (1, 2, 3):
        names += [f"{c}_{i}" for c in ["policy", "iname", "reln", *_EXTENSION]]
    return contract(base, names)


def _policies(benefits: DataFrame, extensions: DataFrame) -> DataFrame:
    """The policies of the visits' patients with their extensions: read once, written, and then joined in each of three roles."""
    found = equi_join(benefits, extensions.select("patno", "seqno", *_EXTENSION), ["patno", "seqno"], ["patno", "seqno"])
    return keep_table(found.select("patno", "histn", "insco", "policy", "iname", "reln", *_EXTENSION))


def billing_census(t: Tables, as_of: date, p: Params) -> DataFrame:
    visit = t.patients.where(on_day("isadate", as_of, 1))
    emergency = t.admreg.where(F.col("admhsv") == S.EMERGENCY).select("patno", "hstnum", "nwdrnum")
    base = (
        Facts(visit)
        .by("hstnum", Look(t.pathist.select("histn", "padr1"), "histn", "inner"))
        .by(["patno", "hstnum"], Look(emergency, ["patno", "hstnum"], "inner"))
        .code("nwdrnum", t.phymast.withColumn("_n", F.col("nwdrnum")).drop("nwdrnum"), "_n", "inner")
        .df
    )
    names = "isadate iatme isddate dtime pname age sex padr1 dcstat diagn phname nwdrnum hstnum patno isdob"
    return contract(base, names.split())


def radiology_charges(t: Tables, as_of: date, p: Params) -> DataFrame:
    charges = t.accumchg.where(
        between_days("ispdatea", as_of, 62, 1)
        & F.col("dept").isin(S.RADIOLOGY_DEPARTMENTS)
        & ~F.col("svccd").isin(S.RADIOLOGY_SKIPPED_CHARGES)
    )
    patients = t.patients.where(F.col("rectyp").isNotNull()).select("patno", "pname", "hssvc", "rectyp")
    found = (
        Facts(charges)
        .by("patno", Look(patients, "patno", "inner"))
        .by("svccd", Look(t.chrgdesc, "svccd"))
        .code("dept", t.glkeysm, "deptg")
        .df
    )
    # The sections are crossed at the source: "Inpatient" lists what is not record type I. Kept.
    section = F.when(F.col("rectyp") != "I", "Inpatient").otherwise("Outpatient")
    names = ["ispdatea", "dept", "gldesc", "patno", "pname", "hssvc", "isdate", "svccd", "desc", "qty", ("qty_2", "qty"), "amt1"]
    return contract(found.withColumn("section", section), ["section", *names])


def radiology_revenue(t: Tables, as_of: date, p: Params, section: str) -> DataFrame:
    """One section, by service, posting date, patient name and charge (columns 6, 1, 5, 9)."""
    rows = radiology_charges(t, as_of, p).where(F.col("section") == section).drop("section")
    positions = [6, 1, 5, 9]
    keys = [rows.columns[n - 1] for n in positions]
    rest = [c for c in rows.columns if c not in keys]
    return rows.orderBy(*[F.asc_nulls_last(c) for c in [*keys, *rest]])
