"""Hospital-shaped views over the driver's star-schema tables.

Projections (and three small groupings for code tables) over whole tables, in
SQL that Spark and DuckDB both accept, so that one text serves the reports and
the checks. `TIMESTAMP_NTZ` is the one type name that differs; see duckdb_views.

Patient numbers are order keys plus one, because 0 means "empty bed". All names,
numbers and codes that come out of this are synthetic.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from wardbook.sources.tables import Tables, without_padding

AS_OF = date(2024, 1, 20)
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _pick(key: str, values: list[str | None]) -> str:
    """CASE that picks one of the values by key modulo their number."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)
    )
    return f"CASE {key} % {len(values)} {arms} END"


def _int(expr: str) -> str:
    return f"CAST({expr} AS INT)"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _back(expr: str) -> str:
    """A day that many days before the as-of date."""
    return f"(DATE '{AS_OF}' - {_int(expr)})"


def _ymd(day: str) -> str:
    return _int(f"replace(substring({_text(day)}, 3, 8), '-', '')")


def _hhmm(key: str) -> str:
    return _int(f"(({key}) % 24) * 100 + (({key}) * 7) % 60")


def _at(day: str, minutes: str) -> str:
    return f"CAST({day} AS TIMESTAMP_NTZ) + INTERVAL '1' MINUTE * {_int(minutes)}"


def _doctor(key: str) -> str:
    return f"'Supplier#' || lpad({_text(key)}, 9, '0')"


SERVICES = ["MIP", "SIP", "OBS", "EOP", "ICU", "CCU", "NUR", "BBN", "OBI", "GYN", "PED", "RE2", "RAD"]
STATIONS = [
    "CCU", "PCU", "CDU", "MCU", "SCUJ", "SSU", "EOP", "NUR", "WHBC", "ICU", "CVIC", "DIAG", "CVPR", None, "", "MCU", "CCU",
]
PROCEDURE_CODES = [
    "COVID-19", "COVID-LC", "COVID-QL", "COVID-CM", "COVID-RO", "INFLUPCR", "ADMHOSP", "ADMOBOBS", "OBSERV", "DCHOME",
    "DCSNF", "DCOTH", "ABGVENBL", "RSV", "CULRESP", "CBC", "BMP", "CXR", "EKG", "UA", "LIPID", "TSH", "XRAY",
]
TEST_CODES = ["COV-CM", "COVPCR", "COV-AG", "FLU-A", "RSV-T", "HGB", "NA"]
RESULTS = [
    "POSITIVE", "NOT DETECTED   ", "NEGATIVE", "POS SARS-COV-2", "LABCORP", "", "        LABCORP", "INVALID", "POSITIVE",
]
PARAMETERS = [
    "Q0000000382", "Q0000000163", "Q0000003057", "Q0000004066", "Q0000005455", "Q0000000124", "Q0000005629",
    "Q0000004013", "Q0000000113", "Q0000009999",
]
NURSING_VALUES = [
    "Peripheral", "PICC;Single Lumen", "Voiding", "Indwelling Catheter", "Contact Isolation",
    "Standard Isolation - Universal Precautions", "No - refused", "Unable to assess", "Denies", "Type 1",
    "Type 2 - Diet Controlled", "", "Unrestricted",
]
NOTE_TITLES = ["Coronavirus Screening", "Progress Note", "Discharge Summary", "Consult", "Coronavirus Follow-up", "History", "Operative Note"]
PROCEDURES = [
    "TOTAL KNEE ARTHROPLASTY", "LAPAROSCOPIC COLECTOMY", "LUMBAR LAMINECTOMY L4-L5", "CATARACT EXTRACTION",
    "ROBOTIC HYSTERECTOMY", "CORONARY ARTERY BYPASS X3", "HERNIA REPAIR", "SHOULDER ARTHROSCOPY", "TONSILLECTOMY",
    "CHOLECYSTECTOMY WITH INTRAOPERATIVE CHOLANGIOGRAM AND LIVER BIOPSY", "TIBIAL OSTEOTOMY",
]

_K, _L, _E = "o_orderkey", "l_orderkey", "event_id"
_ADMITTED = _back(f"{_K} % 31")
_ORDER_NO = f"l_linenumber * {_big('1000000000000')} + l_partkey"
_ORDERED = _back("(l_partkey + l_linenumber) % 37")
_BED_ROOM = f"CASE WHEN {_K} % 29 = 0 THEN 'CVH' ELSE {_text(_big(f'floor({_K} / 4)'))} END"

VIEWS: dict[str, str] = {
    "patients": f"""SELECT {_K} + 1 AS patno, o_custkey + 1 AS hstnum, {_pick(_K, SERVICES)} AS hssvc,
  'Customer#' || lpad({_text('o_custkey')}, 9, '0') AS pname, {_ADMITTED} AS isadate,
  CASE WHEN o_orderstatus = 'O' THEN DATE '0001-01-01' ELSE {_ADMITTED} + {_int(f'{_K} % 17')} END AS isddate,
  {_text(_ADMITTED)} AS adate, {_hhmm(_K)} AS iatme, {_hhmm(f'{_K} + 5')} AS dtime,
  {_ADMITTED} AS isqadte, {_hhmm(f'{_K} + 1')} AS iqtime,
  DATE '1930-01-01' + {_int('(o_custkey * 37) % 33000')} AS isdob,
  {_text(f"DATE '1930-01-01' + {_int('(o_custkey * 37) % 33000')}")} AS dob,
  {_pick('o_custkey', ['F', 'M'])} AS sex, {_int(f'{_K} % 107')} AS age, o_orderpriority AS diagn,
  'D' || {_text(f'{_K} % 997')} AS diag9, {_text(f'{_K} % 5')} AS dcstat, {_text(f'{_K} % 25')} AS fincl,
  {_text(f'{_K} % 113')} AS drg, CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'F' THEN 'O' ELSE 'E' END AS rectyp,
  {_K} % 97 AS nwattphy, {_K} % 89 AS nwrefdoc, {_K} % 101 AS nwdocnum,
  {_pick(_K, ['I1', 'I2'])} AS ains1, {_pick(_K, ['I3', 'I4', None])} AS ains2, {_pick(_K, ['I5', 'I6'])} AS ains3,
  'P' || {_text(f'{_K} % 3')} AS apln1, 'P' || {_text(f'{_K} % 5')} AS apln2, 'P' || {_text(f'{_K} % 7')} AS apln3
FROM orders""",
    "rmbed": f"""SELECT {_pick(_K, STATIONS)} AS nurst, {_BED_ROOM} AS room,
  {_pick(_K, ['A', 'B', 'P', 'A', 'B'])} AS bed,
  CASE WHEN o_orderstatus = 'F' THEN {_big('0')} ELSE {_K} + 1 END AS pat_no, {_pick(_K, ['Y', 'N', None])} AS observ
FROM orders""",
    "pathist": f"""SELECT c_custkey + 1 AS histn, {_pick('c_custkey', ['R1', 'R2', 'R3'])} AS race,
  {_pick('c_custkey', ['M', 'S'])} AS martl, 'S' || lpad({_text('c_custkey')}, 8, '0') AS ssn,
  c_name || ' STREET' AS padr1, 'UNIT ' || {_text('c_nationkey')} AS padr2, c_mktsegment AS hcity,
  lpad({_text('c_nationkey')}, 5, '9') AS zip, lpad({_text('c_nationkey')}, 3, '5') AS harcd,
  lpad({_text('c_custkey')}, 7, '0') AS phone, 'KIN ' || c_name AS c1nam, {_pick('c_custkey', ['SP', 'CH', 'PA'])} AS c1rel,
  '555' AS c1arc, lpad({_text('c_custkey % 977')}, 7, '0') AS c1phn, {_pick('c_custkey', ['I1', 'I2'])} AS ains1,
  {_pick('c_custkey', ['I3', 'I4'])} AS ains2, {_pick('c_custkey', ['I5', 'I6', None])} AS ains3, c_custkey % 97 AS nwfdoc_no
FROM customer""",
    "phymast": "SELECT s_suppkey AS nwdrnum, s_name AS phname FROM supplier",
    "admreg": f"""SELECT {_K} + 1 AS patno, o_custkey + 1 AS hstnum, {_K} % 83 AS nwdrnum,
  {_pick(_K, ['E', 'U', 'L'])} AS atype, {_pick(_K, ['1', '2'])} AS asrce, {_pick(_K, ['WALK', 'AMB', 'CAR', None])} AS arrvd,
  {_pick(f'({_K} + 2)', ['EOP', 'MIP', 'SIP', 'OBS'])} AS admhsv, {_pick(_K, SERVICES)} AS dischsv
FROM orders""",
    "benefits": " UNION ALL ".join(
        f"""SELECT {_K} + 1 AS patno, o_custkey + 1 AS histn, {insco} AS insco, {_int(str(seq))} AS seqno,
  ' POL{seq}-' || {_text(_K)} AS policy, 'HOLDER {seq}' AS iname, {_pick(_K, ['SELF', 'SPOUSE', 'CHILD'])} AS reln FROM orders"""
        for seq, insco in (
            (1, _pick(_K, ["I1", "I2"])),
            (2, _pick(_K, ["I3", "I4", None])),
            (3, _pick(_K, ["I5", "I6"])),
        )
    ),
    "benext": " UNION ALL ".join(
        f"""SELECT {_K} + 1 AS patno, {_int(str(seq))} AS seqno, {_pick(f'({_K} + {seq})', ['MEDICARE', 'BLUE', 'MEDICARE', 'AETHER', 'CASCADE'])} AS ibinam,
  'ADDRESS {seq}' AS ibiadr, 'SUITE ' || {_text(f'{_K} % 7')} AS ibiad2, 'CITY' AS ibicty, 'OR' AS ibstat, '541' AS ibarcd,
  lpad({_text(f'{_K} % 1009')}, 7, '0') AS ibphn1, '' AS ibphn2, '97{seq}01' AS ibizip FROM orders"""
        for seq in (1, 2, 3)
    ),
    "cdnotetb": f"""SELECT {_big(f'floor({_K} / 2)')} * 2 + 1 AS encid, {_pick(_K, NOTE_TITLES)} AS titl,
  {_back(f'{_K} % 59')} AS createdt, {_doctor('o_custkey % 97')} AS crtdname, 'USER' || {_text(f'{_K} % 7')} AS createby,
  o_custkey + 1 AS patient_id
FROM orders""",
    "cdnteatb": f"SELECT {_L} + 1 AS enctrid, 'USER' || {_text('l_linenumber')} AS lstmodby FROM lineitem",
    "trdochp": f"""SELECT o_custkey + 1 AS dhhstno, {_K} + 1 AS dhpatno, {_K} % 103 AS dhdrno,
  {_pick(_K, ['HP', 'DS', 'OP', 'CN'])} AS dhfldr, {_back(f'{_K} % 41')} AS dhdate
FROM orders""",
    "indaccum": f"""SELECT {_doctor('l_suppkey')} AS iapnam, {_L} % 1499 + 1 AS iahst_no, {_ORDER_NO} AS iaord_no,
  {_L} + 1 AS iaacct
FROM lineitem""",
    "dsstat": f"""SELECT {_text('r_regionkey')} AS dcubs, r_name AS dcsds, 'TO ' || r_name AS dcdsc,
  CASE r_regionkey WHEN 2 THEN 'Y' ELSE 'N' END AS dcexp
FROM region""",
    "stathd": f"""SELECT CASE WHEN n_nationkey < {len(SERVICES)} THEN {_pick('n_nationkey', SERVICES)}
  ELSE 'X' || {_text('n_nationkey')} END AS svccd
FROM nation""",
    "patrmbdp": f"""SELECT {_big(f'floor({_E} / 3)')} + 1 AS patn15,
  {_text(_big(f'floor({_E} / 4)'))} AS room, {_pick(_E, ['A', 'B'])} AS bed, CAST(ts AS DATE) AS asgdate,
  ts AS asgtime, CASE event_type WHEN 'click' THEN 'N' ELSE 'Y' END AS recid
FROM events""",
    "chpdtaph": f"""SELECT CASE WHEN {_E} % 4 = 0 THEN user_id + 1 ELSE {_E} + 1 END AS dthpatno,
  CASE event_type WHEN 'view' THEN 'Height' WHEN 'click' THEN 'Weight' ELSE 'Precaution' END AS dthfield,
  CASE event_type WHEN 'view' THEN {_text(_int(f'150 + {_E} % 50'))} || ' cm' WHEN 'click' THEN {_text(_int(f'50 + {_E} % 60'))} || ' kg '
  WHEN 'error' THEN 'Isolation' ELSE 'Falls' END AS dthresp, ts AS dthdttm
FROM events""",
    "chpdrip": f"""SELECT CASE WHEN {_E} % 3 = 0 THEN user_id + 1 ELSE {_E} + 1 END AS cipat_no, event_type AS ciinfctn,
  CAST(ts AS DATE) AS ciiddte, CAST(ts AS DATE) + 1 AS cirecdte, DATE '0001-01-01' AS ciresdte, 'USER' || {_text('user_id')} AS ciresby,
  {_pick(_E, ['A', 'I'])} AS cistscd, props AS cicmmt
FROM events""",
    "rrfaxlog": f"""SELECT {_L} + 1 AS flpt_no, {_ORDER_NO} AS flor_no, {_doctor('l_suppkey')} AS flrcpt,
  '555-' || lpad({_text('l_partkey % 9973')}, 7, '0') AS flsphne, CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'R' THEN 'U' ELSE
  {_pick('l_suppkey', ['S', 'P', None])} END AS flstat, {_back('l_partkey % 29')} AS flidt, {_text(_hhmm('l_partkey'))} AS flitm
FROM lineitem""",
    "accumchg": f"""SELECT {_back('(l_partkey * 7 + l_linenumber) % 89')} AS ispdatea,
  {_int("CASE l_partkey % 8 WHEN 0 THEN 161 WHEN 1 THEN 162 WHEN 2 THEN 163 WHEN 3 THEN 164 WHEN 4 THEN 281 ELSE 300 + l_partkey % 8 END")} AS dept,
  {_L} + 1 AS patno, {_back(f'{_L} % 31')} AS isdate, l_partkey AS svccd, {_big('l_quantity')} AS qty,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS amt1
FROM lineitem""",
    "chrgdesc": "SELECT p_partkey AS svccd, p_name AS desc FROM part",
    "glkeysm": f"""SELECT {_int("CASE n_nationkey WHEN 0 THEN 161 WHEN 1 THEN 162 WHEN 2 THEN 163 WHEN 3 THEN 164 ELSE 400 + n_nationkey END")} AS deptg,
  n_name AS gldesc
FROM nation""",
    "fcdesc": f"SELECT {_text('n_nationkey')} AS fcfincl, n_name AS fdesc FROM nation",
    "drgdesc": f"SELECT {_text('p_partkey')} AS drg, p_type || ' ' || p_name AS drgdes FROM part",
    "username": f"SELECT 'USER' || {_text('s_suppkey')} AS odobnm, s_name || '{{signed' AS odobtx FROM supplier",
    "oeorder": f"""SELECT {_L} + 1 AS opat_no, {_ORDER_NO} AS oord_no, {_pick('l_partkey', PROCEDURE_CODES)} AS oproc,
  l_returnflag AS opty, {_int('l_suppkey % 5')} AS ostat, {_ymd(_ORDERED)} AS osdate, {_hhmm('l_partkey + l_suppkey')} AS ostime,
  {_ORDERED} AS oisrdate, {_pick('(l_partkey + l_suppkey)', ['LAB', 'RAD', 'LAB', 'RT'])} AS otodpt,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '0' ELSE {_pick('l_linenumber', ['0', None])} END AS orflag,
  {_pick('l_suppkey', ['MAIN', 'CLINIC'])} AS optlst, {_pick('l_linenumber', ['Y', 'N', 'N'])} AS oinit,
  'USER' || {_text('l_suppkey')} AS ouser, {_ymd(_ORDERED)} AS oedate, {_hhmm('l_partkey')} AS oetime
FROM lineitem""",
    "oeostat": f"SELECT {_int('r_regionkey')} AS stat_no, CASE r_regionkey WHEN 4 THEN 'CANCELLED' ELSE r_name END AS stdsc FROM region",
    "oeproc": f"SELECT {_pick('p_partkey', PROCEDURE_CODES)} AS pproc, min(p_name) AS povdsc FROM part GROUP BY 1",
    "rd": f"""SELECT {_L} + 1 AS rdpt_no, {_ORDER_NO} AS rdor_no, {_pick('l_linenumber', TEST_CODES)} AS rdts,
  {_pick('(l_suppkey + l_linenumber)', RESULTS)} AS rdrs, 'PF' || {_text('l_linenumber % 3')} AS rdpf,
  {_back('l_partkey % 23')} AS rdisvfdt
FROM lineitem""",
    "rh": f"""SELECT {_L} + 1 AS rhpt_no, {_ORDER_NO} AS rhor_no, {_ORDERED} AS rhiscldt, {_hhmm('l_partkey + 1')} AS rhcltm,
  l_linestatus AS rhtc, {_ORDERED} AS rhisrndt, {_int('(l_partkey * 13) % 2500')} AS rhrntm, {_ORDERED} AS rhisrcdt,
  {_hhmm('l_partkey + 3')} AS rhrctm, {_ORDERED} + 1 AS rhisvfdt, {_int('(l_partkey * 17) % 2400')} AS rhvftm,
  'USER' || {_text('l_suppkey % 11')} AS rhrcby
FROM lineitem""",
    "rmtor": f"""SELECT {_L} + 1 AS rmpt_no, {_ORDER_NO} + CASE l_linestatus WHEN 'F' THEN 0 ELSE {_big('500000000000')} END AS rmor_no,
  'X' || {_text('l_partkey')} AS rmxrf
FROM lineitem""",
    "nctrn": f"""SELECT CASE WHEN {_E} % 3 = 0 THEN user_id + 1 ELSE {_E} + 1 END AS trpat_no, {_pick(_E, PARAMETERS)} AS trprmid,
  CASE WHEN {_E} % 7 < 3 THEN {_at(f"DATE '{AS_OF}' - 1", f'720 + ({_E} * 17) % 720')} ELSE ts END AS trrecdt,
  {_pick(_big(f'floor({_E} / 10)'), NURSING_VALUES)} AS trrecval, props AS trcom, 'USER' || {_text('user_id')} AS trusr
FROM events""",
    "ncprm": f"""SELECT CASE WHEN n_nationkey < {len(PARAMETERS)} THEN {_pick('n_nationkey', PARAMETERS)} ELSE 'Q' || {_text('n_nationkey')} END AS prid,
  CASE n_nationkey WHEN 2 THEN 'I' ELSE 'A' END AS prsts, 'VAL ' || n_name AS prval, n_name AS prds
FROM nation""",
    "casemain": f"""SELECT {_K} AS casemain_id, {_text('o_custkey + 1')} AS pat_acct_num, 'M' || {_text('o_custkey')} AS pat_mrn,
  'Customer#' || {_text('o_custkey')} AS pat_displayname, 'Customer#' || lpad({_text('o_custkey')}, 9, '0') AS pat_legalname,
  'LAST' || {_text('o_custkey % 500')} AS pat_lastname, {_pick('o_custkey', ['F', 'M'])} AS pat_gender,
  {_at("DATE '1930-01-01' + " + _int('(o_custkey * 37) % 33000'), '0')} AS pat_birth_datetime,
  {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440')} AS actcase_start_datetime,
  CASE WHEN {_K} % 11 = 0 THEN NULL
    WHEN {_K} % 13 = 0 THEN {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440 + 5990 + {_K} % 900')}
    WHEN {_K} % 17 = 0 THEN {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440 - 10')}
    ELSE {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440 + 20 + {_K} % 400')} END AS actcase_stop_datetime,
  {_at(_back(f'{_K} % 43 - 3'), f'({_K} * 11) % 1440')} AS schedcase_start_datetime,
  {_at(_back(f'{_K} % 43 - 3'), f'({_K} * 11) % 1440 + 60')} AS schedcase_stop_datetime,
  {_K} % 25 AS actualroom_res_id, 'OR ' || lpad({_text(f'{_K} % 14')}, 2, '0') AS actualroom_res_abbr,
  {_doctor(f'{_K} % 97')} AS attending_res_name
FROM orders""",
    "casepro": f"""SELECT {_L} AS casemain_id, {_pick('l_partkey', PROCEDURES)} AS actual_proname, {_doctor('l_suppkey')} AS primpract_res_name,
  {_int('l_linenumber + 2')} AS woundclass_id
FROM lineitem""",
    "caseintraop": f"""SELECT {_K} AS casemain_id, {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440 - 10')} AS pat_or_in_datetime,
  {_at(_back(f'{_K} % 503'), f'({_K} * 7) % 1440 + 450')} AS pat_or_out_datetime, {_int(f'{_K} % 12')} AS asaclass_id
FROM orders""",
    "casepreop": f"SELECT {_K} AS casemain_id, {_K} % 6 AS pattype_id FROM orders",
    "psmpattype": f"SELECT {_big('r_regionkey')} AS pattype_id, substring(r_name, 1, 3) AS abbr FROM region",
    "psmresindroom": f"SELECT {_big('n_nationkey')} AS res_id FROM nation",
    "patbooking": f"""SELECT o_custkey + 1 AS pat_id, {_K} + 1 AS appt_id, {_at(_back(f'3 - {_K} % 47'), f'({_K} * 13) % 1440')} AS start_datetime,
  {_K} % 97 AS ordering_phys_id, {_K} % 4 AS apptclass_id
FROM orders""",
    "pat": "SELECT c_custkey + 1 AS pat_id, c_name AS name_legal FROM customer",
    "patmrnlist": f"SELECT c_custkey + 1 AS pat_id, 'M' || {_text('c_custkey')} AS mrn FROM customer",
    "visitapptlist": f"SELECT {_K} + 1 AS appt_id, {_K} + 1 AS visit_id FROM orders",
    "visit": f"SELECT {_K} + 1 AS visit_id, o_custkey + 1 AS pat_id FROM orders",
    "appt": f"SELECT {_K} + 1 AS appt_id, {_K} % 5 AS service_id, {_int(f'{_K} % 6')} AS apptstatus_id FROM orders",
    "probooking": f"SELECT {_L} + 1 AS appt_id, {_pick('l_partkey', PROCEDURES)} AS name FROM lineitem",
    "resbooking": f"SELECT {_L} + 1 AS appt_id FROM lineitem",
    "res": "SELECT s_suppkey AS res_id, s_name AS name FROM supplier",
    "service": f"SELECT {_big('r_regionkey')} AS service_id FROM region",
    "apptstatus": f"SELECT {_int('r_regionkey')} AS apptstatus_id FROM region",
    "apptclass": f"SELECT {_big('r_regionkey')} AS apptclass_id FROM region",
}


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The views as tidied tables, each made on first use."""
    given = Tables({name: (lambda name=name: spark.read.parquet(f"{sf_dir}/{name}.parquet")) for name in BASE_TABLES})

    def make(name: str) -> DataFrame:
        # Braces inside literals must survive the formatting of the table names.
        text = VIEWS[name].replace("{", "{{")
        used = {t: given[t] for t in BASE_TABLES if re.search(rf"\bFROM {t}\b", text)}
        for table in used:
            text = re.sub(rf"\bFROM {table}\b", f"FROM {{{table}}}", text)
        # Names and types are the schema's already (tested); only the padding is left.
        return without_padding(spark.sql(text, **used), name)

    return Tables({name: (lambda name=name: make(name)) for name in VIEWS})


def duckdb_views(sql: str) -> str:
    """The query with the views it names put in front as common table expressions."""
    needed = [name for name in VIEWS if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE)]
    texts = [f"{name} AS (\n{VIEWS[name].replace('TIMESTAMP_NTZ', 'TIMESTAMP')}\n)" for name in needed]
    head = "WITH " + ",\n".join(texts) if texts else ""
    body = sql.strip()
    if texts and body.upper().startswith("WITH "):
        return head + ",\n" + body[5:]
    return head + "\n" + body
