"""Hand-made tables with the awkward rows, and what the reports must make of them."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Row

from wardbook.plans import census, extracts, notes, orders, surgery, throughput
from wardbook.plans.settings import Params
from wardbook.sources import schemas
from wardbook.sources.tables import Tables, tidy

AS_OF = date(2024, 1, 20)
YESTERDAY = date(2024, 1, 19)
IN = date(1, 1, 1)

BEDS = [
    dict(nurst="CCU ", room="101", bed="A", pat_no=1),
    dict(nurst="PCU ", room="102", bed="A", pat_no=0),
    dict(nurst="PCU ", room="102", bed="B", pat_no=2),
    dict(nurst=None, room="103", bed="A", pat_no=3),
    dict(nurst="    ", room="104", bed="A", pat_no=4),
    dict(nurst="MCU ", room="105", bed="P ", pat_no=5),
    dict(nurst="NUR ", room="106", bed="A", pat_no=6),
    dict(nurst="EOP ", room="107", bed="A", pat_no=7),
    dict(nurst="CDU ", room="108", bed="A", pat_no=0),
    dict(nurst="MCU ", room="108", bed="A", pat_no=8),
]
PATIENTS = [
    dict(patno=1, hstnum=11, hssvc="ICU", pname="ONE", isadate=YESTERDAY, isddate=IN, age=90, iatme=5),
    dict(patno=2, hstnum=12, hssvc="MIP", pname="TWO", isadate=AS_OF, isddate=IN, age=91, iatme=45),
    dict(patno=3, hstnum=13, hssvc="MIP", pname="THREE", isadate=YESTERDAY, isddate=YESTERDAY, age=100, iatme=930),
    dict(patno=4, hstnum=14, hssvc="EOP", pname="FOUR", isadate=AS_OF, isddate=IN, age=30, iatme=1430),
    dict(patno=5, hstnum=15, hssvc="OBS", pname="FIVE", isadate=YESTERDAY, isddate=IN, age=31, iatme=2400),
    dict(patno=6, hstnum=16, hssvc="NUR", pname="SIX", isadate=AS_OF, isddate=IN, age=0, iatme=0),
    dict(patno=7, hstnum=17, hssvc="SIP", pname="SEVEN", isadate=YESTERDAY, isddate=IN, age=50, iatme=1),
    dict(patno=8, hstnum=18, hssvc="MIP", pname="EIGHT", isadate=YESTERDAY, isddate=IN, age=89, iatme=100),
    dict(patno=9, hstnum=19, hssvc="EOP", pname="NINE", isadate=AS_OF, isddate=AS_OF, age=20, iatme=100),
]
RESULTS = [
    dict(rdpt_no=1, rdor_no=1, rdts="COV-CM", rdrs="NOT DETECTED   ", rdpf="PF0", rdisvfdt=YESTERDAY),
    dict(rdpt_no=1, rdor_no=2, rdts="COV-CM", rdrs="POSITIVE", rdpf="PF0", rdisvfdt=AS_OF),
    dict(rdpt_no=2, rdor_no=1, rdts="FLU", rdrs="POSITIVE", rdpf="PF0", rdisvfdt=AS_OF),
    dict(rdpt_no=4, rdor_no=1, rdts="XCOVX", rdrs="NOT DETECTED", rdpf="PF1", rdisvfdt=AS_OF),
    dict(rdpt_no=7, rdor_no=1, rdts="COV-CM", rdrs="        LABCORP", rdpf="PF0", rdisvfdt=AS_OF),
    dict(rdpt_no=7, rdor_no=2, rdts="COV-CM", rdrs="               ", rdpf="PF0", rdisvfdt=AS_OF),
    dict(rdpt_no=8, rdor_no=1, rdts="COV-CM", rdrs="NEGATIVE", rdpf="PF0", rdisvfdt=AS_OF),
]
ORDERS = [
    dict(opat_no=1, oord_no=1, oproc="COVID-19", ostat=1, osdate=240118, otodpt="LAB", orflag="0", ostime=5),
    dict(opat_no=1, oord_no=2, oproc="COVID-CM", ostat=4, osdate=240119, otodpt="LAB", orflag="0", ostime=400),
    dict(opat_no=2, oord_no=1, oproc="ADMHOSP", ostat=None, osdate=240120, otodpt="LAB", orflag="0", ostime=2400),
    dict(opat_no=7, oord_no=1, oproc="COVID-19", ostat=1, osdate=240120, otodpt="RAD", orflag="0", ostime=300),
    dict(opat_no=8, oord_no=1, oproc="COVID-19", ostat=1, osdate=240120, otodpt="LAB", orflag=None, ostime=401),
]


@pytest.fixture(scope="module")
def t(spark):
    def make(name, rows=()):
        columns = schemas.columns(name)
        data = [tuple(r.get(c) for c in columns) for r in rows]
        return tidy(spark.createDataFrame(data, schemas.schema(name)), name)

    filled = {
        "rmbed": BEDS,
        "patients": PATIENTS,
        "rd": RESULTS,
        "oeorder": ORDERS,
        "oeostat": [dict(stat_no=1, stdsc="DONE"), dict(stat_no=4, stdsc="CANCELLED")],
        "rh": [dict(rhpt_no=2, rhor_no=1, rhcltm=930, rhrntm=2500, rhvftm=None), dict(rhpt_no=8, rhor_no=1, rhcltm=1)],
        "cdnotetb": [
            dict(encid=1, titl="Coronavirus Screening", createdt=AS_OF, crtdname="SMITHSON, J", createby="u1"),
            dict(encid=2, titl="Progress", createdt=date(2024, 1, 6), crtdname="JONES, K", createby="u1"),
            dict(encid=2, titl="Progress", createdt=date(2024, 1, 5), crtdname="JONES, K", createby="u2"),
        ],
        "cdnteatb": [dict(enctrid=1, lstmodby="u1"), dict(enctrid=1, lstmodby="u1"), dict(enctrid=1, lstmodby="u9")],
        "casemain": [
            dict(casemain_id=1, pat_acct_num="1", actcase_start_datetime=datetime(2024, 1, 19, 23, 59, 30)),
            dict(
                casemain_id=2, pat_acct_num="1", actcase_start_datetime=datetime(2024, 1, 19, 8),
                actcase_stop_datetime=datetime(2024, 1, 19, 10, 5), pat_birth_datetime=datetime(1950, 2, 3),
            ),
            dict(casemain_id=3, pat_acct_num="x", actcase_start_datetime=datetime(2024, 1, 19, 9)),
            dict(casemain_id=4, pat_acct_num="3", actcase_start_datetime=datetime(2024, 1, 20)),
        ],
        "casepro": [
            dict(casemain_id=2, actual_proname="KNEE ARTHROPLASTY", woundclass_id=9),
            dict(casemain_id=2, actual_proname="BIOPSY", woundclass_id=5),
            dict(casemain_id=1, actual_proname="LAMINECTOMY", woundclass_id=7),
            dict(casemain_id=3, actual_proname="COLECTOMY", woundclass_id=3),
        ],
        "caseintraop": [dict(casemain_id=2, asaclass_id=4)],
        "benefits": [
            dict(patno=1, seqno=1, policy=" OLD "), dict(patno=1, seqno=2, policy=" NEW "), dict(patno=1, seqno=3, policy="OTHER"),
        ],
        "benext": [
            dict(patno=1, seqno=1, ibinam="MEDICARE"), dict(patno=1, seqno=2, ibinam="MEDICARE"), dict(patno=1, seqno=3, ibinam="BLUE"),
        ],
        "chpdtaph": [
            dict(dthpatno=1, dthfield="Height", dthresp="180 cm ", dthdttm=datetime(2024, 1, 2)),
            dict(dthpatno=1, dthfield="Height", dthresp="181 cm", dthdttm=datetime(2024, 1, 1)),
            dict(dthpatno=99, dthfield="Weight", dthresp="80", dthdttm=datetime(2024, 1, 1)),
        ],
        "nctrn": [dict(trpat_no=1, trprmid="Q0000005629", trrecval="Type 1 ", trrecdt=datetime(2024, 1, 1))],
        "patrmbdp": [
            dict(patn15=1, room="102", asgdate=YESTERDAY, asgtime=datetime(2024, 1, 19, 8, 1)),
            dict(patn15=1, room="101", asgdate=YESTERDAY, asgtime=datetime(2024, 1, 19, 9, 1)),
            dict(patn15=1, room="108", asgdate=YESTERDAY, asgtime=datetime(2024, 1, 19, 9, 50)),
            dict(patn15=1, room="HALL", asgdate=AS_OF, asgtime=datetime(2024, 1, 20, 9, 50)),
            dict(patn15=2, room="nowhere", asgdate=AS_OF, asgtime=datetime(2024, 1, 20, 9, 50)),
        ],
    }
    return Tables({name: (lambda name=name: make(name, filled.get(name, ()))) for name in schemas.TABLES})


def by(df, key) -> dict[object, Row]:
    got = df.collect()
    assert len({r[key] for r in got}) == len(got)
    return {r[key]: r for r in got}


def test_padded_codes_and_empty_beds(t):
    found = by(census.house_census(t, AS_OF, Params()), "room")
    assert set(found) == {"101", "102", "104", "105", "106", "108"}
    assert found["101"]["nurst"] == "CCU" and found["102"]["pname"] == "TWO"


def test_bed_feed(t):
    rows = extracts.bed_feed(t, AS_OF, Params()).collect()
    assert len(rows) == 8
    taken = {(r["Room"], r["Bed"], r["Unit"]): r["isOccupied"] for r in rows}
    assert taken[("102", "A", "PCU")] is False and taken[("102", "B", "PCU")] is True
    assert ("103", "A", None) in taken and not any(r["Bed"] == "P" or r["Unit"] == "NUR" for r in rows)


def test_bed_extract(t):
    df = extracts.bed_extract(t, AS_OF, Params())
    rows = df.collect()
    beds = {(r["Room"], r["Bed"]): r for r in rows if r["Room"]}
    # Skipped units, unknown stations and the second entry of 108-A are not beds of the extract.
    assert set(beds) == {("101", "A"), ("102", "A"), ("102", "B"), ("104", "A"), ("105", "P"), ("108", "A")}
    one = beds[("101", "A")]
    assert (one["LevelofCareGroup"], one["patientAge"], one["PatientAdmitDate"]) == ("Adult ICU 3", "90", "2024-01-19T00:05:00Z")
    assert one["isPatientLevelCareICU"] is True and one["PatientCOVIDStatus"] == "NEGATIVE"
    empty = beds[("102", "A")]
    assert empty["isOccupied"] is False and empty["patientAge"] is None and empty["isPatientLevelCareICU"] is None
    assert beds[("102", "B")]["patientAge"] == "90+" and beds[("102", "B")]["PatientCOVIDStatus"] is None
    assert beds[("105", "P")]["PatientAdmitDate"] is None
    # The patient of the dropped entry still comes, without a bed.
    lost = [r for r in rows if r["Room"] is None]
    assert len(lost) == 1 and lost[0]["PatientCOVIDStatus"] == "NEGATIVE" and lost[0]["TimeStamp"] is None
    assert beds[("108", "A")]["Unit"] == "CDU"


def test_emergency_extract(t):
    rows = extracts.emergency_extract(t, AS_OF, Params()).collect()
    # Patient 4 registered today on a blank station, patient 7 lies in an emergency bed; 9 went home today.
    assert sorted((r["RegistrationTimeStamp"], r["isPatientBoarding"], r["PatientCOVIDStatus"]) for r in rows) == [
        ("2024-01-19T00:01:00", True, ""),
        ("2024-01-19T00:01:00", True, "        LABCORP"),
        ("2024-01-20T14:30:00", False, "Negative"),
    ]


def test_results_count_each_order_and_skip_what_says_nothing(t):
    got = orders.results_by_code(t, AS_OF, Params(excluded_patients=[8], result_groups=["PF0"])).collect()
    assert sorted((r["pname"], r["rdrs"], r["copies"], r["first_osdate"]) for r in got) == [
        ("ONE", "NOT DETECTED", 2, 240118),
        ("ONE", "POSITIVE", 2, 240118),
    ]
    totals = orders.result_totals(t, AS_OF, Params(excluded_patients=[], result_groups=["PF0"])).collect()
    assert [(r["rdrs"], r["n"]) for r in totals] == [("NOT DETECTED", 2), ("POSITIVE", 2), ("NEGATIVE", 1)]


def test_turnaround_times(t):
    rows = orders.lab_turnaround(t, AS_OF, Params()).collect()
    # 24:00 is above 400 and 401 is too late; the others are of another day or department.
    assert rows == []
    monitor = by(orders.lab_monitor(t, AS_OF, Params()), "patno")
    assert set(monitor) == {1, 2} and monitor[2]["status"] is None and monitor[2]["rhcltm"] == 930


def test_missing_admit_orders(t):
    found = by(census.missing_admit_orders(t, AS_OF, Params()), "patno")
    assert set(found) == {1, 3, 5, 6, 7, 8}


def test_log_takes_the_first_case_of_an_account_and_the_whole_day(t):
    log = by(surgery.or_log_yesterday(t, AS_OF, Params()), "pat_acct_num")
    assert set(log) == {"1", "x"}
    assert log["1"]["actcase_start_datetime"].hour == 8 and log["1"]["procedure"] == "BIOPSY"
    assert str(log["1"]["birthdate"]) == "1950-02-03"
    late = by(surgery.or_log_yesterday(Tables({**_makers(t), "casemain": lambda: t.casemain.where("casemain_id = 1")}), AS_OF, Params()), "pat_acct_num")
    assert late["1"]["procedure"] == "LAMINECTOMY"


def _makers(t):
    return {name: (lambda name=name: t[name]) for name in t}


def test_denominator(t):
    got = {(r["patid"], r["actual_proname"]): r for r in surgery.surgical_denominator(t, AS_OF, Params()).collect()}
    assert set(got) == {("1", "KNEE ARTHROPLASTY"), ("1", "LAMINECTOMY"), ("x", "COLECTOMY")}
    knee = got[("1", "KNEE ARTHROPLASTY")]
    assert (knee["medicareid"], knee["height"], knee["weight"], knee["diabetes"], knee["outpatient"]) == ("NEW", "180 cm", None, "Y", "N")
    assert (knee["procdurationhr"], knee["procdurationmin"], knee["swclass"], knee["asaclass"]) == ("02", "05", "C", "2E")
    assert (knee["dob"], knee["procdate"], knee["closure"], knee["infection"]) == ("02/03/1950", "01/19/2024", "Pri", "")
    assert got[("1", "LAMINECTOMY")]["procdurationhr"] is None and got[("1", "LAMINECTOMY")]["swclass"] is None
    assert got[("x", "COLECTOMY")]["outpatient"] is None and got[("x", "COLECTOMY")]["swclass"] == "CC"


def test_notes_match_every_prefix_and_count_edits(t):
    p = Params(note_authors=["SMI", "SMITH", "JONES"])
    rows = notes.notes_by_author(t, AS_OF, p, 14).collect()
    assert sorted((r["section"], r["encid"], r["copies"]) for r in rows) == [("JONES", 2, 1), ("SMI", 1, 2), ("SMITH", 1, 2)]
    p = Params(noted_since=date(2024, 1, 1))
    assert [r["pat_no"] for r in notes.patients_with_note(t, AS_OF, p).collect()] == [1]
    assert sorted(r["pat_no"] for r in notes.patients_without_note(t, AS_OF, p).collect()) == [2, 4, 5, 8]


def test_last_move_to_a_known_room(t):
    rows = throughput.last_moves(t, AS_OF, Params()).collect()
    assert [(r["patno"], r["room"], r["asgtime"], r["nurst"]) for r in rows] == [(1, "108", 9, "MCU")]


def test_admissions_need_a_station(t):
    found = by(census.admissions(t, AS_OF, Params()), "patno")
    # The blank station counts as one, the missing one does not.
    assert {k: r["section"] for k, r in found.items()} == {1: "inpatient", 5: "OBS", 7: "inpatient", 8: "inpatient"}
