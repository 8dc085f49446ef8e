WITH person AS (
  -- patients of the clinic's family doctors
  SELECT patients.*, phname, dcdsc
  FROM patients JOIN pathist ON histn = hstnum LEFT JOIN phymast ON nwdrnum = nwfdoc_no LEFT JOIN dsstat ON dcubs = dcstat
  WHERE nwfdoc_no IN (SELECT range FROM range(3, 60, 4)))
SELECT pname, isdob, isadate, iatme, isddate, dcdsc, diagn, phname
FROM person LEFT JOIN stathd ON svccd = hssvc LEFT JOIN rmbed ON pat_no = patno
WHERE hssvc = 'EOP' AND DATE '2024-01-20' - isadate = 1
