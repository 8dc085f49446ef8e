WITH fax AS (
  SELECT rrfaxlog.*, oproc FROM rrfaxlog JOIN oeorder ON (opat_no, oord_no) = (flpt_no, flor_no)
  WHERE otodpt = 'LAB' AND DATE '2024-01-20' - flidt = 1)
SELECT flstat, count(flstat) AS n FROM fax GROUP BY flstat HAVING count(flstat) > 0
