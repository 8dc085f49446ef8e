WITH sent AS (
  SELECT opat_no AS pat, oord_no AS ord, osdate FROM oeorder WHERE osdate = 240119 AND optlst = 'MAIN'),
back AS (
  SELECT rdpt_no AS pat, rdor_no AS ord, rdts, rtrim(rdrs) AS rdrs FROM rd WHERE rdts = 'COV-CM')
SELECT iapnam, harcd, phone, rdts, rdrs, osdate
FROM sent JOIN back USING (pat, ord) JOIN indaccum ON (iaacct, iaord_no) = (pat, ord) LEFT JOIN pathist ON histn = iahst_no
