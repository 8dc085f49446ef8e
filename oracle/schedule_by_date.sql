WITH surgeon AS (FROM (VALUES ('Supplier#00000000'), ('Supplier#00000001'), ('Supplier#000000012'), ('Supplier#00000003'), ('Supplier#00000005')) AS s(prefix)),
asked AS (
  SELECT res_id, name AS physician FROM res WHERE EXISTS (FROM surgeon WHERE starts_with(name, prefix))),
slot AS MATERIALIZED (
  SELECT patbooking.*, physician
  FROM patbooking JOIN asked ON res_id = ordering_phys_id JOIN appt USING (appt_id) JOIN visitapptlist USING (appt_id)
  SEMI JOIN apptstatus USING (apptstatus_id)
  WHERE apptstatus_id <> 2
    AND start_datetime >= TIMESTAMP '2024-01-20 00:00:00' AND start_datetime < TIMESTAMP '2024-02-25 00:00:00'),
booked AS (
  SELECT CAST(start_datetime AS DATE) AS startdate, name_legal, mrn, probooking.name AS surgeryname, physician, appt_id
  FROM slot LEFT JOIN pat USING (pat_id) LEFT JOIN patmrnlist USING (pat_id)
  LEFT JOIN probooking USING (appt_id) LEFT JOIN resbooking USING (appt_id))
SELECT startdate, count(*) AS n FROM booked GROUP BY startdate
