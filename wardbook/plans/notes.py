"""Notes and transcriptions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import between_days
from wardbook.functions.codes import bucket
from wardbook.operators.dedup import copies, expand_copies
from wardbook.operators.joins import Facts, Look, in_roster, stack_sources, with_row_id
from wardbook.operators.prefixes import prefix_join
from wardbook.operators.shape import contract, ordered
from wardbook.plans import settings as S
from wardbook.plans.census import taken_beds
from wardbook.plans.settings import Params, value_list
from wardbook.sources.tables import Tables


def notes_by_author(t: Tables, as_of: date, p: Params, days: int, authors: DataFrame | None = None) -> DataFrame:
    """Notes of the last `days` days, one section per author prefix.

    The source joins each note to its edits without showing them, which lists a
    note once per edit. That number is in `copies` here; expand_copies writes
    the rows out.
    """
    notes = with_row_id(t.cdnotetb.where(between_days("createdt", as_of, days)))
    matched = prefix_join(notes, authors if authors is not None else p.note_authors, "crtdname")
    matched = matched.withColumn("section", F.col("prefix"))
    patients = t.patients.select("patno", "hssvc", "hstnum", "pname", "isdob")
    edits = copies(t.cdnteatb, ["enctrid", "lstmodby"])
    found = (
        Facts(matched)
        .by("encid", Look(patients, "patno", "inner"))
        .by(["encid", "createby"], Look(edits, ["enctrid", "lstmodby"]))
        .df
    )
    names = [*"section hssvc hstnum encid pname isdob titl createdt crtdname".split(), ("copies", F.coalesce("copies", F.lit(1)))]
    return contract(found, names)


def notes_rows(t: Tables, as_of: date, p: Params, days: int = 14) -> DataFrame:
    """The notes as the source lists them, once per edit."""
    return expand_copies(notes_by_author(t, as_of, p, days))


def _census_by_note(t: Tables, p: Params, how: str) -> DataFrame:
    """Occupied beds whose patient has the note (left_semi) or has not (left_anti)."""
    recent = t.patients.where(F.col("isadate") > F.lit(p.noted_since)).select("patno")
    notes = t.cdnotetb.where(F.col("titl").startswith(S.NOTE_TITLE_PREFIX)).select("encid").distinct()
    noted = in_roster(notes, recent, "encid", "patno")
    beds = taken_beds(t).where(~F.col("nurst").isin(S.NOTE_SKIPPED_UNITS))
    found = Facts(beds).by("pat_no", Look(noted, "encid", how), Look(t.patients.select("patno", "isadate"), "patno")).df
    return contract(found, "pat_no isadate nurst room bed".split())


def patients_with_note(t: Tables, as_of: date, p: Params) -> DataFrame:
    """The audit list: who was left out of the main list."""
    return _census_by_note(t, p, "left_semi")


def patients_without_note(t: Tables, as_of: date, p: Params) -> DataFrame:
    section = bucket("nurst", S.NOTE_BUCKETS, S.NOTE_BUCKET_OTHER).alias("section")
    return ordered(_census_by_note(t, p, "left_anti").select(section, "*"), "section", "nurst")


def department_documents(t: Tables, as_of: date, p: Params, days: int = 7) -> DataFrame:
    """Notes by author prefix and transcriptions by provider, in one layout."""
    spark = t.cdnotetb.sparkSession
    out = ["mrn", "account_number", "patient_name", "physician", "document", "document_date"]
    notes = with_row_id(t.cdnotetb.where(between_days("createdt", as_of, days)))
    notes = prefix_join(notes, p.note_authors, "crtdname")
    patients = t.patients.select("patno", "hstnum", "pname")
    notes = Facts(notes).by(["encid", "patient_id"], Look(patients, ["patno", "hstnum"])).df
    notes = ordered(contract(notes, list(zip(out, ["patient_id", "encid", "pname", "crtdname", "titl", "createdt"]))), "patient_name")
    spoken = t.trdochp.where(between_days("dhdate", as_of, days))
    spoken = in_roster(spoken, value_list(spark, p.transcription_providers, "dhdrno"), "dhdrno")
    spoken = (
        Facts(spoken)
        .by(["dhpatno", "dhhstno"], Look(patients, ["patno", "hstnum"]))
        .by("dhdrno", Look(t.phymast, "nwdrnum"))
        .df
    )
    spoken = contract(spoken, list(zip(out, ["dhhstno", "dhpatno", "pname", "phname", "dhfldr", "dhdate"])))
    return stack_sources(notes, spoken)
