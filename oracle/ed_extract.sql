WITH present_now AS (
  SELECT patno, isadate, iatme, age, coalesce(trim(nurst) <> '', false) AS boarding
  FROM patients LEFT JOIN rmbed ON pat_no = patno
  WHERE nurst = 'EOP' OR (hssvc = 'EOP' AND isadate = DATE '2024-01-20' AND isddate <> DATE '2024-01-20'))
SELECT '2024-01-20T00:00:00Z' AS "TimeStamp", CAST(isadate AS VARCHAR) || 'T' || (CASE WHEN iatme BETWEEN 0 AND 2359 AND iatme % 100 < 60 THEN format('{:02d}:{:02d}:00', iatme // 100, iatme % 100) END) AS "RegistrationTimeStamp",
       'General Hospital' AS "System", 'General Hospital' AS "Facility", '0000001' AS "FacilityID",
       boarding AS "isPatientBoarding", replace(rtrim(rdrs), 'NOT DETECTED', 'Negative') AS "PatientCOVIDStatus",
       CAST(age AS VARCHAR) AS "patientAge"
FROM present_now JOIN rd ON rdpt_no = patno
WHERE contains(rdts, 'COV')
