WITH beds AS (
  SELECT nurst, room, bed, pat_no FROM rmbed
  WHERE nurst NOT IN ('WHBC', 'NUR', 'SSU', 'DIAG', 'EOP', '*VNS', 'CVPR') AND room <> 'CVH'),
places AS (
  SELECT nullif(pat_no, 0) AS pat, nurst AS unit, room, bed,
         CASE nurst WHEN 'CCU' THEN 'Adult ICU 3' WHEN 'PCU' THEN 'Adult PCU' WHEN 'CDU' THEN 'Adult OBS' ELSE 'Adult Med Surg' END AS care,
         pat_no > 0 AS occupied
  FROM beds
  QUALIFY row_number() OVER (PARTITION BY room, bed ORDER BY nurst, pat_no) = 1),
people AS (
  SELECT patno AS pat, hssvc = 'ICU' AS icu, age,
         CAST(isadate AS VARCHAR) || 'T' || (CASE WHEN iatme >= 0 AND iatme // 100 < 24 AND iatme % 100 < 60 THEN substr(lpad(CAST(iatme AS VARCHAR), 4, '0'), 1, 2) || ':' || substr(lpad(CAST(iatme AS VARCHAR), 4, '0'), 3, 2) || ':00' END) || 'Z' AS admitted
  FROM patients
  WHERE patno IN (SELECT pat_no FROM beds)
  QUALIFY row_number() OVER (PARTITION BY patno ORDER BY isadate) = 1),
results AS (
  SELECT rdpt_no AS pat, CASE rtrim(rdrs) WHEN 'NOT DETECTED' THEN 'NEGATIVE' ELSE rtrim(rdrs) END AS status
  FROM rd
  WHERE rdts LIKE 'COV%' AND rdpt_no IN (SELECT pat_no FROM beds)
  QUALIFY row_number() OVER (PARTITION BY rdpt_no ORDER BY rdisvfdt, rdor_no, rdts, status) = 1),
first_merge AS (
  SELECT coalesce(places.pat, people.pat) AS pat, places.* EXCLUDE (pat), people.* EXCLUDE (pat)
  FROM places FULL OUTER JOIN people ON places.pat = people.pat)
SELECT CASE WHEN care IS NOT NULL THEN '2024-01-20T00:00:00Z' END AS "TimeStamp",
       CASE WHEN care IS NOT NULL THEN 'General Hospital' END AS "System",
       CASE WHEN care IS NOT NULL THEN 'General Hospital' END AS "Facility",
       CASE WHEN care IS NOT NULL THEN '0000001' END AS "FacilityID",
       unit AS "Unit", room AS "Room", bed AS "Bed",
       CASE WHEN care IS NOT NULL THEN 'Regular' END AS "BedType",
       care AS "LevelofCareGroup",
       CASE WHEN care IS NOT NULL THEN true END AS "isActive",
       occupied AS "isOccupied",
       CASE WHEN care IS NOT NULL THEN false END AS "isBlocked",
       status AS "PatientCOVIDStatus",
       icu AS "isPatientLevelCareICU",
       admitted AS "PatientAdmitDate",
       CASE WHEN age > 90 THEN '90+' ELSE CAST(age AS VARCHAR) END AS "patientAge"
FROM first_merge FULL OUTER JOIN results ON first_merge.pat = results.pat
