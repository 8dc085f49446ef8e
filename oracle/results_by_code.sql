WITH said AS (
  SELECT rdpt_no, rdpf AS section, rtrim(rdrs) AS rdrs, rdisvfdt FROM rd
  WHERE rdpf IN ('PF0', 'PF1') AND trim(rdrs) NOT IN ('', 'OR PUB.HLTH.LAB', 'LABCORP', 'CALL IF NEG', 'CALL IF POS', '*')),
tested AS (
  SELECT opat_no, count(*) AS copies, min(osdate) AS first_osdate FROM oeorder WHERE oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO') GROUP BY opat_no)
SELECT section, pname, dob, rdisvfdt, rdrs, copies, first_osdate
FROM said JOIN tested ON opat_no = rdpt_no JOIN patients ON patno = rdpt_no
WHERE patno NOT IN (11, 101, 1001)
