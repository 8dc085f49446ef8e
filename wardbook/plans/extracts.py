"""Feeds in a fixed layout: bed feed, bed extract, emergency extract, hospitalist extract."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.clock import hhmm_pad, iso_of, iso_z_of, los_days, same_day
from wardbook.functions.codes import map_codes, normalise
from wardbook.functions.predicates import occupied, present
from wardbook.functions.text import nth_part, top_code, zero_to_null
from wardbook.operators.dedup import one_per_key, single
from wardbook.operators.joins import Facts, Look, equi_join, join_chain, meet, merge, role, sift_all, sift_to
from wardbook.operators.shape import contract, nothing
from wardbook.plans import settings as S
from wardbook.plans.census import taken_beds
from wardbook.plans.orders import packed_day
from wardbook.plans.settings import Params
from wardbook.sources.tables import Tables


def _stamp(as_of: date, pattern: str = "%Y-%m-%dT%H:%M:%SZ") -> str:
    at = as_of if isinstance(as_of, datetime) else datetime.combine(as_of, time())
    return at.strftime(pattern)


def bed_feed(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Each staffed bed and whether it is taken.

    A taken bed says TRUE on every unit, and each bed comes once: the source
    script wrote its list again for each bed and kept the patient number on one unit.
    """
    beds = t.rmbed.where(~F.col("bed").eqNullSafe("P") & ~F.col("nurst").eqNullSafe("NUR"))
    return contract(
        beds,
        [
            ("Timestamp of record", F.lit(_stamp(as_of, "%Y-%m-%dT%H:%MZ"))),
            ("System", F.lit(p.system)),
            ("Facility", F.lit(p.facility)),
            ("Unit", "nurst"),
            ("Room", "room"),
            ("Bed", "bed"),
            ("isOccupied", F.col("pat_no") != 0),
            ("isBlocked", F.lit(False)),
            ("isVentCapable", F.lit(False)),
        ],
    )


def bed_extract(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Beds merged with their patients and the patients' virus results.

    A bed listed twice is kept once, the first by unit; a patient whose bed was
    the other one still comes, without a bed, as in an outer merge. Of several
    results the first by verification date counts.
    """
    beds = t.rmbed.where(~F.col("nurst").isin(S.EXTRACT_SKIPPED_UNITS) & (F.col("room") != S.EXTRACT_SKIPPED_ROOM))
    beds = beds.select("nurst", "room", "bed", "pat_no")
    constants = {
        "TimeStamp": F.lit(_stamp(as_of)),
        "System": F.lit(p.system),
        "Facility": F.lit(p.facility),
        "FacilityID": F.lit(p.facility_id),
        "BedType": F.lit("Regular"),
        "isActive": F.lit(True),
        "isBlocked": F.lit(False),
        "LevelofCareGroup": map_codes("nurst", S.CARE_LEVELS, S.CARE_LEVEL_OTHER),
        "isOccupied": occupied("pat_no"),
    }
    places = one_per_key(beds, ["room", "bed"], ["nurst", "pat_no"])
    places = places.withColumns(constants).withColumn("pat_no", zero_to_null("pat_no"))

    patients = t.patients.select(
        "patno",
        "isadate",
        F.lit(True).alias("is_patient"),
        F.col("hssvc").eqNullSafe(S.ICU).alias("isPatientLevelCareICU"),
        iso_z_of("isadate", "iatme").alias("PatientAdmitDate"),
        top_code("age", 90).alias("patientAge"),
    )
    status = normalise("rdrs", {"NOT DETECTED": "NEGATIVE"})
    results = t.rd.where(F.col("rdts").startswith(S.VIRUS_TEST_PREFIX)).select(
        "rdpt_no", "rdisvfdt", "rdor_no", "rdts", F.lit(True).alias("is_result"), status.alias("PatientCOVIDStatus")
    )
    details = ["isPatientLevelCareICU", "PatientAdmitDate", "patientAge"]
    occupants = beds.where(occupied("pat_no")).select("pat_no").distinct()
    patients, results = sift_all([(patients, "patno"), (results, "rdpt_no")], occupants, "pat_no")
    occupants = join_chain(
        occupants,
        [
            (single(patients, "patno", ["is_patient", *details], ["isadate"], "first").picked, "pat_no", "patno"),
            (
                single(
                    results, "rdpt_no", ["is_result", "PatientCOVIDStatus"], ["rdisvfdt", "rdor_no", "rdts"], "first"
                ).picked,
                "pat_no",
                "rdpt_no",
            ),
        ],
    ).where(F.col("is_patient").isNotNull() | F.col("is_result").isNotNull())

    merged = merge(places, occupants, "pat_no", "full_outer", row_key=["room", "bed"])
    return contract(
        merged,
        [
            *"TimeStamp System Facility FacilityID".split(),
            ("Unit", "nurst"),
            ("Room", "room"),
            ("Bed", "bed"),
            *"BedType LevelofCareGroup isActive isOccupied isBlocked PatientCOVIDStatus".split(),
            *details,
        ],
    )


def emergency_extract(t: Tables, as_of: date, p: Params) -> DataFrame:
    """Virus results of patients in the emergency department.

    In it: registered there today and not discharged today, or in one of its
    beds. A patient with a station is boarding. All results are kept.
    """
    patients = t.patients.select("patno", "hssvc", "isadate", "isddate", "iatme", "age")
    beds = taken_beds(t).select("pat_no", "nurst")
    today = (F.col("hssvc") == S.EMERGENCY) & same_day("isadate", as_of) & (F.col("isddate") != F.lit(as_of))
    registered = equi_join(patients.where(today), beds, "patno", "pat_no")
    in_bed = beds.where(F.col("nurst") == S.EMERGENCY)
    not_today = ~F.coalesce(today, F.lit(False))
    in_bed = Facts(in_bed).by("pat_no", Look(patients.where(not_today).withColumn("_p", F.col("patno")), "_p", "inner")).df
    present_now = registered.unionByName(in_bed.drop("pat_no")).select(
        "patno",
        iso_of("isadate", "iatme").alias("RegistrationTimeStamp"),
        present("nurst").alias("isPatientBoarding"),
        F.col("age").cast("string").alias("patientAge"),
    )
    results = t.rd.where(F.col("rdts").contains(S.VIRUS_TEST_PREFIX)).select(
        "rdpt_no", normalise("rdrs", {"NOT DETECTED": "Negative"}).alias("PatientCOVIDStatus")
    )
    found = meet(results, "rdpt_no", present_now, "patno")
    return contract(
        found,
        [
            ("TimeStamp", F.lit(_stamp(as_of))),
            "RegistrationTimeStamp",
            ("System", F.lit(p.system)),
            ("Facility", F.lit(p.facility)),
            ("FacilityID", F.lit(p.facility_id)),
            "isPatientBoarding",
            "PatientCOVIDStatus",
            "patientAge",
        ],
    )


# Fixed value: the column heads of the hospitalist extract, in order. A head without
# a source column is a constant NULL.
_HOSPITALIST = [
    ("Med_Rec_No", "patno"),
    ("Acct_No", "hstnum"),
    ("Date_Of_Birth", "isdob"),
    ("Gender", "sex"),
    ("FinancialClass_code", "fincl"),
    ("FinancialClass_Def", "fdesc"),
    ("ED_Arrival_Date", None),
    ("ED_Arrival_Time", None),
    ("ED_Dispo_Date", None),
    ("ED_Dispo_Time", None),
    ("ED_Depart_Time", None),
    ("Admiss_Date", "isadate"),
    ("Admiss_Time", "admit_time"),
    ("Admiss_From_Code", None),
    ("Admiss_From_Definition", "arrvd"),
    ("Discharge_Date", "isddate"),
    ("Discharge_Time", "dtime"),
    ("Admitting_Phys", "phname_ref"),
    ("Attending_Phys", "phname_att"),
    ("Discharging_Phys", "discharging"),
    ("DC_Order_Date", "oedate"),
    ("DC_Order_Time", "oetime"),
    ("DC_Dispo_Code", None),
    ("DC_Dispo_Def", "oproc"),
    ("Discharge_Unit", None),
    ("MSDRG_code", "drg"),
    ("MSDRG_Code_Des", "drgdes"),
    ("APRDRG_Code", None),
    ("APRDRG_Desc", None),
    ("ICD1", "diag9"),
    ("ICD2", None),
    ("ICD3", None),
    ("LengthOfStay", "stay"),
    ("PtStatus_Admission", "admhsv"),
    ("PtStatus_Dicharge", "dischsv"),
    ("ICU_Stay", None),
    ("Cost_Total", None),
    ("Cost_Direct_Rad", None),
    ("Cost_Direct_Pharm", None),
    ("Cost_Direct_Lab", None),
]


def hospitalist_extract(t: Tables, as_of: date, p: Params, days: int = 32) -> DataFrame:
    """Discharge orders of the hospitalists' patients.

    Either admitted in the window, or discharged in it by a user on the roster.
    The first two heads hold the account and the record number in that order,
    as in the source feed.
    """
    patients = t.patients.where(
        ~F.col("hssvc").isin(S.HOSPITALIST_SKIPPED_SERVICES) & F.col("nwattphy").isin(p.hospitalists)
    )
    recent = F.coalesce(F.col("isadate") >= F.lit(as_of - timedelta(days=days)), F.lit(False))
    by_user = F.coalesce((F.col("oedate") >= packed_day(as_of, days)) & F.col("ouser").isin(p.order_users), F.lit(False))
    # One reading of the orders: those by a user on the roster, and those of the admitted, whose keys come along.
    orders = t.oeorder.where(F.col("oproc").isin(S.DISCHARGE_ORDERS))
    orders = orders.select("opat_no", "oproc", "ouser", "oedate", "oetime", by_user.alias("by_user"))
    orders = sift_to(orders, "opat_no", patients.where(recent), "patno", also=F.col("by_user"))
    registered = t.admreg.select("patno", "hstnum", "arrvd", "admhsv", "dischsv")
    patients = patients.withColumns({"recent": recent, "_p": F.col("patno")})
    found = Facts(orders).by("opat_no", Look(patients, "_p", "inner")).where(F.col("recent") | F.col("by_user"))
    found = found.code(["patno", "hstnum"], registered, ["patno", "hstnum"], "inner").by("ouser", Look(t.username, "odobnm")).df
    found = join_chain(
        found,
        [
            (t.fcdesc, "fincl", "fcfincl"),
            (t.drgdesc.withColumnRenamed("drg", "_d"), "drg", "_d"),
            (role(t.phymast, "_ref"), "nwrefdoc", "nwdrnum_ref"),
            (role(t.phymast, "_att"), "nwattphy", "nwdrnum_att"),
        ],
    ).withColumns(
        {
            "admit_time": hhmm_pad("iatme"),
            "discharging": nth_part("odobtx", "{", 1),
            "stay": los_days("isadate", "isddate").cast("bigint"),
        }
    )
    return contract(found, [(head, column or nothing()) for head, column in _HOSPITALIST])
