WITH virus_order AS (
  -- Every result of a reported group, once for each virus order of its patient.
  SELECT opat_no AS patno FROM oeorder WHERE oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO')),
said AS (
  SELECT rdpt_no AS patno, rdpf AS section, rdisvfdt, rtrim(rdrs) AS rdrs FROM rd
  WHERE rdpf IN ('PF0', 'PF1')
    -- Fixed value: answers that are no result.
    AND trim(rdrs) NOT IN ('', 'OR PUB.HLTH.LAB', 'LABCORP', 'CALL IF NEG', 'CALL IF POS', '*'))
SELECT section, pname, dob, rdisvfdt, rdrs
FROM said JOIN virus_order USING (patno) JOIN patients USING (patno)
WHERE patno NOT IN (11, 101, 1001)
