SELECT patno, isddate, hssvc, ciinfctn, ciiddte, cirecdte, ciresdte, ciresby, cistscd, cicmmt
FROM chpdrip JOIN patients ON patno = cipat_no
WHERE DATE '2024-01-20' - isddate = 1 AND hssvc IN ('MIP', 'SIP', 'ICU', 'CCU', 'OBS', 'BBN', 'NUR', 'OBI', 'GYN')
