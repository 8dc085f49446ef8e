"""Lists the reports filter by.

Code lists that decide which rows a report holds are fixed values and are stated
here as they are. Everything that names a person, an account or a site is a
parameter (`Params`); its defaults are synthetic and fit the stand-in views.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# --- fixed values: service and station codes ---------------------------------

OBSERVATION = "OBS"
EMERGENCY = "EOP"
ICU = "ICU"
CCU = "CCU"

CENSUS_SKIPPED_UNITS = ["SSU", "EOP"]
LINE_UNITS = ["SCUJ", "WHBC", "PCU", "MCU", "CCU", "CDU"]
LINE_UNITS_DRESSING = ["MCU", "CCU", "PCU", "SCUJ", "WHBC"]
NURSING_UNITS = ["CDU", "CVIC", "ICU", "SCUJ", "WHBC", "PCU", "CCU", "MCU"]
ISOLATION_UNITS = ["CDU", "CVIC", "ICU", "SCUJ", "WHBC", "PCU", "CCU", "MCU", "NUR"]
CLINIC_UNITS = ["CDU", "ICU", "CVIC", "SCUJ", "SSU", "NUR", "WHBC", "PCU", "CCU", "MCU"]
NOTE_SKIPPED_UNITS = ["DIAG", "NUR", "WHBC", "CVPR", "EOP"]
EXTRACT_SKIPPED_UNITS = ["WHBC", "NUR", "SSU", "DIAG", "EOP", "*VNS", "CVPR"]
EXTRACT_SKIPPED_ROOM = "CVH"

CLINIC_SERVICES = ["SIP", "MIP", "OBS", "NUR", "PED", "BBN", "CCU", "GYN", "HSI", "ICU"]
DEATH_SERVICES = ["SIP", "MIP", "ICU", "GYN", "CCU", "PED", "OBS", "OBI", "NUR"]
ORGANISM_SERVICES = ["MIP", "SIP", "ICU", "CCU", "OBS", "BBN", "NUR", "OBI", "GYN"]
INPATIENT_SERVICES = ["MIP", "SIP", "OBS", "OBI", "NUR", "BBN", "ICU", "CCU"]
HOSPITALIST_SKIPPED_SERVICES = ["RAD", "CAT", "BBN", "NUR", "RE2", "INF", "LAB"]
THROUGHPUT_SKIPPED_SERVICES = ["GIO", "SOP", "CAT", "WCC", "LAB", "OS1", "RE2", "RAD", "INF", "CAR", "MOP", "REF"]
COMMUNITY_SERVICE = "RE2"

THROUGHPUT_SKIPPED_ROOMS = [
    "VMCU", "HALL", "VCDU", "VCCU", "VOR", "VSCJ", "VPCU", "VSSU", "VCVP", "1", "2", "3", "4", "5", "6", "7", "8",
    "9", "10", "11", "12", "13", "14", "15", "16", "17", "S01", "S02", "S03", "S04", "S05", "S06", "S07", "S08",
    "S09", "S10", "S11", "S12", "S13", "S14", "S15", "S16", "S17", "S18", "S19", "S20", "S21", "S22", "S23", "S24",
    "S25", "S26", "S27", "S28", "S29", "S30", "S31", "S32", "S33", "S34", "S35", "S36", "S37", "S38", "S39", "S40",
    "SER1", "SER2",
]

# --- fixed values: order, result and nursing codes -----------------------------

FLU_ORDER = "INFLUPCR"
VIRUS_ORDERS = ["COVID-19", "COVID-LC", "COVID-QL", "COVID-CM", "COVID-RO"]
ADMIT_ORDERS = [
    "ADMHOSP", "ADMIPB1R", "ADMIPOPR", "ADMIP2DR", "ADMITIP", "ADMOBINP", "ADMOBOBS", "IPSCU", "OBSERV", "ERINPT", "EROBS",
]
DISCHARGE_ORDERS = [
    "DCLTCH", "DCHOSPM", "DCSTGHIC", "DCAIRF", "DCHOME", "DCHOMEHH", "DCHOSP", "DCICF", "DCIPR", "DCSNF", "DCACF", "DCFAC",
    "DCHWHH", "DCIHOSP", "DCOTH",
]
RESPIRATORY_ORDERS = [
    "ABGCAPI", "ABGCORDV", "AP", "ABGCORDA", "ABGELGLU", "RSV", "FLU/RVP", "RESPDFA", "BORDPER", "BPRTAB", "ABGERPNL",
    "ABGORPNL", "ABGO2SAT", "ABGVENBL", "CULRSP", "CARBONM", "FLU/PCR", "FLUABAB", "FLUABAG", "FLUEABPCR", "HINFBIGG",
    "INFABDFA", "FLUPCR", "INFLUAB", "INFLUWOP", "RVPPCR", "SPECCOLL", "RVP PCR", "FLUPCRAB", "INFLUPCR", "RVPPCREX",
    "CULRESP", "CULLRES", "CULAFBPL", "RVP-PCR", "COVID-19", "COVID-QL", "COVID-LC", "COVID-CM", "COVID-RO",
]
RESULT_NOT_ONE = ["OR PUB.HLTH.LAB", "LABCORP", "CALL IF NEG", "CALL IF POS", "*"]
POSITIVE = "POSITIVE"
POSITIVE_VIRUS_PREFIX = "POS SARS"
EMPLOYEE_TEST = "COV-CM"
VIRUS_TEST_PREFIX = "COV"
CANCELLED = "CANCELLED"
PENDING_STATUS = 3
LAB = "LAB"
RADIOLOGY = "RAD"

CATHETER_PARAMETERS = ["Q0000000382", "Q0000004576"]
CATHETER_NOT_ONE = ["Voiding", "Incontinent", "Other-See Comment", "Straight Catheter"]
LINE_PARAMETERS_DAILY = [
    "Q0000000163", "Q0000004013", "Q0000003057", "Q0000000169", "Q0000000168", "Q0000000667", "Q0000000672",
]
LINE_PARAMETERS = [
    "Q0000000163", "Q0000004054", "Q0000000168", "Q0000000169", "Q0000000667", "Q0000000672", "Q0000004013",
    "Q0000004035", "Q0000004027", "Q0000003057",
]
LINE_PARAMETERS_DRESSING = ["Q0000004066", "Q0000004049", "Q0000003057", "Q0000004030"]
LINE_NOT_CENTRAL = [
    "Peripheral;Saline Lock", "Peripheral;Double Lumen", "Peripheral", "Peripheral;Saline Lock;Single Lumen",
    "Peripheral;Single Lumen", "Peripheral;Saline Lock;Double Lumen", "Saline Lock",
]
ISOLATION_PARAMETER = "Q0000005455"
ISOLATION_STANDARD = "Standard Isolation - Universal Precautions"
ISOLATION_AFTER = "16:00:00"
ISOLATION_RESPONSE = "Isolation"
VACCINE_PARAMETERS = ["Q0000000124", "Q0000000113"]
VACCINE_NOT_GIVEN = ["No", "", "Una", "Unr"]
DIABETES_PARAMETER = "Q0000005629"
NOTE_TITLE_PREFIX = "Coronavirus"

# --- fixed values: revenue -----------------------------------------------------

RADIOLOGY_DEPARTMENTS = [161, 162, 163, 164, 281]
RADIOLOGY_SKIPPED_CHARGES = [2811277, 2811241, 2811255, 2811167, 2811256, 2811238, 2811243]

# --- fixed values: maps ----------------------------------------------------------

CARE_LEVELS = {"CCU": "Adult ICU 3", "PCU": "Adult PCU", "CDU": "Adult OBS"}
CARE_LEVEL_OTHER = "Adult Med Surg"
ROOM_NAMES = {
    "OR 01": "OPERATING ROOM 1",
    "OR 02": "OPERATING ROOM 2",
    "OR 03": "OPERATING ROOM 3",
    "OR 04": "OPERATING ROOM 4",
    "OR 05": "OPERATING ROOM 5",
    "OR 06": "OPERATING ROOM 6",
    "OR 07": "OPERATING ROOM 7",
    "OR 08": "OPERATING ROOM 8",
    "OR 09": "OPERATING ROOM 9",
    "OR 10": "OPERATING ROOM 10",
    "OR 11": "OPERATING ROOM 11",
    "OR 12": "OPERATING ROOM 12",
}
WOUND_CLASSES = {9: "C", 3: "CC", 4: "CO", 5: "D"}
ASA_CLASSES = {1: "1", 2: "1E", 3: "2", 4: "2E", 5: "3", 6: "3E", 7: "4", 8: "4E", 9: "5", 10: "5E"}
DIABETES_YES = [
    "Type 1", "Type 2 - Insulin Controlled", "Type 2 - Oral Medication Controlled", "Type 2 - Diet Controlled",
]
NOTE_BUCKETS = [(unit, unit) for unit in ("CCU", "CDU", "MCU", "PCU", "SCUJ")]
NOTE_BUCKET_OTHER = "SSU"
SURGICAL_KEYWORDS = [
    "ARTHROPLASTY", "COLOSTOMY", "ROBOTIC HYSTERECTOMY", "LAMINECTOMY", "ARTHROSCOPY", "HEMILAMINECTOMY", "OSTEOTOMY",
    "LAMINECTOMIES", "COLECTOMY", "HYSTERECTOMY", "CORONARY ARTERY BYPASS",
]
MEDICARE = "MEDICARE"
CANCELLED_APPOINTMENT = 2


def _supplier(digits: str) -> str:
    return f"Supplier#{digits}"


@dataclass(frozen=True)
class Params:
    """What differs from site to site. The defaults are synthetic."""

    system: str = "General Hospital"
    facility: str = "General Hospital"
    facility_id: str = "0000001"
    site_code: str = "MAIN"
    excluded_patients: list[int] = field(default_factory=lambda: [11, 101, 1001])
    result_groups: list[str] = field(default_factory=lambda: ["PF0", "PF1"])
    clinic_providers: list[int] = field(default_factory=lambda: list(range(3, 60, 4)))
    hospitalists: list[int] = field(default_factory=lambda: list(range(1, 80, 3)))
    transcription_providers: list[int] = field(default_factory=lambda: list(range(2, 60, 7)))
    order_users: list[str] = field(default_factory=lambda: [f"USER{n}" for n in range(0, 1000, 9)])
    note_authors: list[str] = field(
        default_factory=lambda: [_supplier(d) for d in ("00000000", "00000001", "000000012", "00000004", "000000045")]
    )
    surgeons: list[str] = field(
        default_factory=lambda: [_supplier(d) for d in ("00000000", "00000001", "000000012", "00000003", "00000005")]
    )
    surgeons_second: list[str] = field(default_factory=lambda: [_supplier(d) for d in ("00000000", "000000052")])
    noted_since: date = date(2023, 12, 31)
    flu_season_start: date = date(2023, 12, 21)


def value_list(spark: SparkSession, values, column: str) -> DataFrame:
    """A parameter list as a local table, whose size Spark knows when it plans the join."""
    kind = pa.string() if values and isinstance(values[0], str) else pa.int64()
    return spark.createDataFrame(pa.table({column: pa.array(values, kind)}))
