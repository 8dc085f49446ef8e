"""Column types of the source tables.

One line per table: `name:type` pairs. L long, I int, S text, C text that is
blank-padded at the source, D date, T timestamp without zone, M money.
Names are in the tidy form: lower case, `pat#` written `pat_no`.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "L": T.LongType(),
    "I": T.IntegerType(),
    "S": T.StringType(),
    "C": T.StringType(),
    "D": T.DateType(),
    "T": T.TimestampNTZType(),
    "M": T.DecimalType(15, 2),
}

CLINICAL = {
    "patients": "patno:L hstnum:L hssvc:C pname:S isadate:D isddate:D adate:S iatme:I dtime:I isqadte:D iqtime:I "
    "isdob:D dob:S sex:S age:I diagn:S diag9:S dcstat:S fincl:S drg:S rectyp:S nwattphy:L nwrefdoc:L nwdocnum:L "
    "ains1:S ains2:S ains3:S apln1:S apln2:S apln3:S",
    "rmbed": "nurst:C room:C bed:C pat_no:L observ:S",
    "pathist": "histn:L race:S martl:S ssn:S padr1:S padr2:S hcity:S zip:S harcd:S phone:S c1nam:S c1rel:S c1arc:S "
    "c1phn:S ains1:S ains2:S ains3:S nwfdoc_no:L",
    "phymast": "nwdrnum:L phname:S",
    "admreg": "patno:L hstnum:L nwdrnum:L atype:S asrce:S arrvd:S admhsv:S dischsv:S",
    "benefits": "patno:L histn:L insco:S seqno:I policy:S iname:S reln:S",
    "benext": "patno:L seqno:I ibinam:S ibiadr:S ibiad2:S ibicty:S ibstat:S ibarcd:S ibphn1:S ibphn2:S ibizip:S",
    "cdnotetb": "encid:L titl:S createdt:D crtdname:S createby:S patient_id:L",
    "cdnteatb": "enctrid:L lstmodby:S",
    "trdochp": "dhhstno:L dhpatno:L dhdrno:L dhfldr:S dhdate:D",
    "indaccum": "iapnam:S iahst_no:L iaord_no:L iaacct:L",
    "dsstat": "dcubs:S dcsds:S dcdsc:S dcexp:S",
    "stathd": "svccd:S",
    "patrmbdp": "patn15:L room:S bed:S asgdate:D asgtime:T recid:S",
    "chpdtaph": "dthpatno:L dthfield:S dthresp:S dthdttm:T",
    "chpdrip": "cipat_no:L ciinfctn:S ciiddte:D cirecdte:D ciresdte:D ciresby:S cistscd:S cicmmt:S",
    "rrfaxlog": "flpt_no:L flor_no:L flrcpt:S flsphne:S flstat:S flidt:D flitm:S",
    "accumchg": "ispdatea:D dept:I patno:L isdate:D svccd:L qty:L amt1:M",
    "chrgdesc": "svccd:L desc:S",
    "glkeysm": "deptg:I gldesc:S",
    "fcdesc": "fcfincl:S fdesc:S",
    "drgdesc": "drg:S drgdes:S",
    "username": "odobnm:S odobtx:S",
}

ORDERS = {
    "oeorder": "opat_no:L oord_no:L oproc:S opty:S ostat:I osdate:I ostime:I oisrdate:D otodpt:S orflag:S optlst:S "
    "oinit:S ouser:S oedate:I oetime:I",
    "oeostat": "stat_no:I stdsc:S",
    "oeproc": "pproc:S povdsc:S",
    "rd": "rdpt_no:L rdor_no:L rdts:S rdrs:C rdpf:S rdisvfdt:D",
    "rh": "rhpt_no:L rhor_no:L rhiscldt:D rhcltm:I rhtc:S rhisrndt:D rhrntm:I rhisrcdt:D rhrctm:I rhisvfdt:D "
    "rhvftm:I rhrcby:S",
    "rmtor": "rmpt_no:L rmor_no:L rmxrf:S",
    "nctrn": "trpat_no:L trprmid:S trrecdt:T trrecval:S trcom:S trusr:S",
    "ncprm": "prid:S prsts:S prval:S prds:S",
}

SCHEDULING = {
    "casemain": "casemain_id:L pat_acct_num:S pat_mrn:S pat_displayname:S pat_legalname:S pat_lastname:S pat_gender:S "
    "pat_birth_datetime:T actcase_start_datetime:T actcase_stop_datetime:T schedcase_start_datetime:T "
    "schedcase_stop_datetime:T actualroom_res_id:L actualroom_res_abbr:S attending_res_name:S",
    "casepro": "casemain_id:L actual_proname:S primpract_res_name:S woundclass_id:I",
    "caseintraop": "casemain_id:L pat_or_in_datetime:T pat_or_out_datetime:T asaclass_id:I",
    "casepreop": "casemain_id:L pattype_id:L",
    "psmpattype": "pattype_id:L abbr:S",
    "psmresindroom": "res_id:L",
    "patbooking": "pat_id:L appt_id:L start_datetime:T ordering_phys_id:L apptclass_id:L",
    "pat": "pat_id:L name_legal:S",
    "patmrnlist": "pat_id:L mrn:S",
    "visitapptlist": "appt_id:L visit_id:L",
    "visit": "visit_id:L pat_id:L",
    "appt": "appt_id:L service_id:L apptstatus_id:I",
    "probooking": "appt_id:L name:S",
    "resbooking": "appt_id:L",
    "res": "res_id:L name:S",
    "service": "service_id:L",
    "apptstatus": "apptstatus_id:I",
    "apptclass": "apptclass_id:L",
}

_ALL = {**CLINICAL, **ORDERS, **SCHEDULING}
TABLES: tuple[str, ...] = tuple(_ALL)


def _pairs(table: str) -> list[list[str]]:
    return [pair.split(":") for pair in _ALL[table].split()]


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[code]) for name, code in _pairs(table)])


def columns(table: str) -> list[str]:
    return [name for name, _ in _pairs(table)]


def padded(table: str) -> list[str]:
    return [name for name, code in _pairs(table) if code == "C"]
