WITH fax AS (
  SELECT rrfaxlog.*, oproc FROM rrfaxlog JOIN oeorder ON (opat_no, oord_no) = (flpt_no, flor_no)
  WHERE otodpt = 'LAB' AND DATE '2024-01-20' - flidt = 1)
SELECT flpt_no, pname, flor_no, povdsc, flrcpt, flsphne, flstat, flidt AS "date", flitm
FROM fax LEFT JOIN patients ON patno = flpt_no LEFT JOIN oeproc ON pproc = oproc
