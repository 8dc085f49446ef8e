WITH said AS (
  SELECT rdpt_no, rdpf AS section, rtrim(rdrs) AS rdrs, rdisvfdt FROM rd
  WHERE rdpf IN ('PF0', 'PF1') AND trim(rdrs) NOT IN ('', 'OR PUB.HLTH.LAB', 'LABCORP', 'CALL IF NEG', 'CALL IF POS', '*'))
SELECT section, rdrs, count(*) AS n
FROM said JOIN oeorder ON opat_no = rdpt_no JOIN patients ON patno = rdpt_no
WHERE oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO') AND patno NOT IN (11, 101, 1001)
GROUP BY section, rdrs
