WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pat_acct_num ORDER BY actcase_start_datetime, casemain_id) AS place
  FROM casemain
  WHERE actcase_start_datetime >= TIMESTAMP '2024-01-01 00:00:00' AND actcase_start_datetime < TIMESTAMP '2024-01-20 00:00:00'),
procedure_done AS (
  SELECT casemain_id, min(actual_proname) AS actual_proname FROM casepro GROUP BY casemain_id),
done AS (
  SELECT casemain_id, actual_proname, min(primpract_res_name) AS primpract_res_name
  FROM procedure_done JOIN casepro USING (casemain_id, actual_proname) GROUP BY ALL),
logged AS (
  SELECT ranked.*, actual_proname, primpract_res_name, pat_or_in_datetime, pat_or_out_datetime, abbr
  FROM ranked LEFT JOIN done USING (casemain_id) LEFT JOIN caseintraop USING (casemain_id)
  LEFT JOIN casepreop USING (casemain_id) LEFT JOIN psmpattype USING (pattype_id)
  WHERE place = 1)
SELECT actcase_start_datetime, pat_acct_num, pat_mrn, pat_displayname, CAST(pat_birth_datetime AS DATE) AS birthdate, abbr,
       pat_or_in_datetime, pat_or_out_datetime, primpract_res_name, actual_proname AS procedure
FROM logged
