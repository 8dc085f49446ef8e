WITH surgeon AS (FROM (VALUES ('Supplier#00000000'), ('Supplier#00000001'), ('Supplier#000000012'), ('Supplier#00000003'), ('Supplier#00000005')) AS s(prefix))
SELECT pat_acct_num AS "Account Number", pat_legalname AS "Patient Name", attending_res_name AS "Physician Name",
       schedcase_start_datetime AS "Scheduled Date", left(actual_proname, 50) AS "Procedure"
FROM casemain LEFT JOIN casepro USING (casemain_id)
WHERE schedcase_start_datetime BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-21 00:00:00'
  AND EXISTS (FROM surgeon WHERE starts_with(attending_res_name, prefix))
