"""Patient flow: admissions, room moves and the stations they end on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import between_days
from wardbook.operators.counts import group_size, value_counts
from wardbook.operators.dedup import one_per_key
from wardbook.operators.joins import Facts, Look, equi_join
from wardbook.operators.keep import keep
from wardbook.operators.shape import contract
from wardbook.plans import settings as S
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables

DAYS = 27


def last_moves(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Each patient admitted in the window with the last move to a known room.

    The source pairs every move with every bed of its room and keeps the last row
    per patient. The last row is the last move with the last station of its room,
    so rooms and moves are cut to one before they meet.
    """
    admitted = t.patients.where(
        between_days("isadate", as_of, DAYS) & ~F.col("hssvc").isin(S.THROUGHPUT_SKIPPED_SERVICES)
    ).select("patno", "isadate", "iatme", "hssvc")
    moves = t.patrmbdp.where(between_days("asgdate", as_of, DAYS) & ~F.col("room").isin(S.THROUGHPUT_SKIPPED_ROOMS))
    moves = moves.select(F.col("patn15").alias("patno"), "room", "asgdate", F.hour("asgtime").cast("bigint").alias("asgtime"))
    rooms = one_per_key(t.rmbed.select("room", "nurst"), "room", ["nurst"], "last")
    placed = Facts(moves).by("room", Look(rooms.withColumn("_r", F.col("room")).drop("room"), "_r", "inner")).df
    last_move = one_per_key(placed, "patno", ["asgdate", "asgtime", "room", "nurst"], "last")
    last_admission = one_per_key(admitted, "patno", ["isadate", "iatme"], "last")
    found = equi_join(last_admission, last_move.withColumnRenamed("patno", "_p"), "patno", "_p", "inner")
    return contract(found, "patno isadate iatme hssvc room asgdate asgtime nurst".split())


def by_move_date(t: Tables, as_of: date, p: Params) -> DataFrame:
    return group_size(last_moves(t, as_of, p), ["asgdate", "nurst"])


def by_station(t: Tables, as_of: date, p: Params) -> DataFrame:
    return group_size(last_moves(t, as_of, p), ["nurst", "asgdate", "asgtime"])


def by_admit_date(t: Tables, as_of: date, p: Params) -> DataFrame:
    return value_counts(last_moves(t, as_of, p), "isadate", order=False)


def throughput(t: Tables, as_of: date, p: Params) -> dict[str, DataFrame]:
    moves = keep(last_moves(t, as_of, p))
    return {
        "All Data": moves,
        "Total by Move Date": group_size(moves, ["asgdate", "nurst"]),
        "Total by Nurse Station": group_size(moves, ["nurst", "asgdate", "asgtime"]),
        "Total by Admit Date": value_counts(moves, "isadate", order=False),
    }
