WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pat_acct_num ORDER BY actcase_start_datetime, casemain_id) AS place
  FROM casemain
  WHERE actcase_start_datetime >= TIMESTAMP '2023-12-01 00:00:00' AND actcase_start_datetime < TIMESTAMP '2024-01-20 00:00:00'),
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
SELECT casemain_id, pat_acct_num, pat_lastname, primpract_res_name, pat_or_in_datetime, pat_or_out_datetime,
       actcase_start_datetime, actcase_stop_datetime, schedcase_start_datetime, schedcase_stop_datetime,
       -- Fixed value: room names.
       CASE actualroom_res_abbr
         WHEN 'OR 01' THEN 'OPERATING ROOM 1'
         WHEN 'OR 02' THEN 'OPERATING ROOM 2'
         WHEN 'OR 03' THEN 'OPERATING ROOM 3'
         WHEN 'OR 04' THEN 'OPERATING ROOM 4'
         WHEN 'OR 05' THEN 'OPERATING ROOM 5'
         WHEN 'OR 06' THEN 'OPERATING ROOM 6'
         WHEN 'OR 07' THEN 'OPERATING ROOM 7'
         WHEN 'OR 08' THEN 'OPERATING ROOM 8'
         WHEN 'OR 09' THEN 'OPERATING ROOM 9'
         WHEN 'OR 10' THEN 'OPERATING ROOM 10'
         WHEN 'OR 11' THEN 'OPERATING ROOM 11'
         WHEN 'OR 12' THEN 'OPERATING ROOM 12'
       END AS "Room Name",
       actual_proname AS "Procedure"
FROM logged
