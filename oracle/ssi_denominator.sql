WITH policy AS (
  SELECT patno, trim(policy) AS answer FROM benefits
  SEMI JOIN (SELECT patno, seqno FROM benext WHERE ibinam = 'MEDICARE') AS medicare USING (patno, seqno)
  QUALIFY row_number() OVER (PARTITION BY patno ORDER BY seqno DESC, answer DESC) = 1),
height AS (
  SELECT dthpatno AS patno, trim(dthresp) AS answer FROM chpdtaph
  WHERE dthfield = 'Height'
  QUALIFY row_number() OVER (PARTITION BY dthpatno ORDER BY dthdttm DESC, answer DESC) = 1),
weight AS (
  SELECT dthpatno AS patno, trim(dthresp) AS answer FROM chpdtaph
  WHERE dthfield = 'Weight'
  QUALIFY row_number() OVER (PARTITION BY dthpatno ORDER BY dthdttm DESC, answer DESC) = 1),
diabetes AS (
  SELECT trpat_no AS patno, if(trim(trrecval) IN ('Type 1', 'Type 2 - Insulin Controlled', 'Type 2 - Oral Medication Controlled', 'Type 2 - Diet Controlled'), 'Y', 'N') AS answer FROM nctrn
  WHERE trprmid = 'Q0000005629'
  QUALIFY row_number() OVER (PARTITION BY trpat_no ORDER BY trrecdt DESC, answer DESC) = 1),
watched AS (
  SELECT * FROM casepro
  -- Fixed value: watched procedures.
  WHERE regexp_matches(actual_proname, 'ARTHROPLASTY|COLOSTOMY|ROBOTIC HYSTERECTOMY|LAMINECTOMY|ARTHROSCOPY|HEMILAMINECTOMY|OSTEOTOMY|LAMINECTOMIES|COLECTOMY|HYSTERECTOMY|CORONARY ARTERY BYPASS')),
done AS (
  SELECT *, CAST(pat_acct_num AS BIGINT) AS patno, date_diff('minute', actcase_start_datetime, actcase_stop_datetime) AS minutes
  FROM watched JOIN casemain USING (casemain_id) LEFT JOIN caseintraop USING (casemain_id)
  WHERE actcase_start_datetime >= TIMESTAMP '2022-10-01 00:00:00' AND actcase_start_datetime <= TIMESTAMP '2024-01-31 00:00:00')
SELECT pat_acct_num AS patid, policy.answer AS medicareid, pat_displayname AS "patient name", pat_gender AS gender,
       strftime(pat_birth_datetime, '%m/%d/%Y') AS dob,
       if(stay.patno IS NULL, NULL, height.answer) AS height, if(stay.patno IS NULL, NULL, weight.answer) AS weight,
       actual_proname, '' AS proccode, '' AS jntreptype, '' AS jntreptot, '' AS jntrephemi, '' AS jntrepres,
       strftime(actcase_start_datetime, '%m/%d/%Y') AS procdate, diabetes.answer AS diabetes, 'N' AS emergency, 'N' AS trauma,
       -- Fixed value: anaesthesia classes.
       CASE asaclass_id WHEN 1 THEN '1' WHEN 2 THEN '1E' WHEN 3 THEN '2' WHEN 4 THEN '2E' WHEN 5 THEN '3' WHEN 6 THEN '3E'
         WHEN 7 THEN '4' WHEN 8 THEN '4E' WHEN 9 THEN '5' WHEN 10 THEN '5E' END AS asaclass,
       'Y' AS anesthesia,
       if(minutes >= 0, format('{:02d}', minutes // 60), NULL) AS procdurationhr,
       if(minutes >= 0, format('{:02d}', minutes % 60), NULL) AS procdurationmin,
       if(stay.patno IS NULL, NULL, if(stay.isadate = stay.isddate, 'Y', 'N')) AS outpatient,
       'N' AS scope, CASE woundclass_id WHEN 9 THEN 'C' WHEN 3 THEN 'CC' WHEN 4 THEN 'CO' WHEN 5 THEN 'D' END AS swclass, 'Pri' AS closure, '' AS infection
FROM done
LEFT JOIN policy USING (patno) LEFT JOIN height USING (patno) LEFT JOIN weight USING (patno) LEFT JOIN diabetes USING (patno)
LEFT JOIN patients AS stay ON stay.patno = done.patno
