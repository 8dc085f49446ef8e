WITH positive AS (
  -- one row per positive result of a virus order, with whatever is known of patient, bed and status
  SELECT oproc, osdate, stdsc, rtrim(rdrs) AS rdrs, patno AS patient, pname, hssvc, isadate, nurst, room, bed
  FROM oeorder JOIN rd ON (rdpt_no, rdor_no) = (opat_no, oord_no)
  LEFT JOIN patients ON patno = opat_no LEFT JOIN rmbed ON pat_no = opat_no LEFT JOIN oeostat ON stat_no = ostat
  WHERE rtrim(rdrs) = 'POSITIVE' OR starts_with(rdrs, 'POS SARS'))
SELECT count(oproc) AS oproc, count(hssvc) AS hssvc, count(patient) AS patient, count(pname) AS pname, count(isadate) AS isadate,
       count(room) AS room, count(bed) AS bed, count(nurst) AS nurst, count(osdate) AS osdate, count(stdsc) AS stdsc,
       count(rdrs) AS rdrs
FROM positive
WHERE oproc = 'INFLUPCR' AND rdrs = 'POSITIVE' AND hssvc <> 'EOP' AND stdsc <> 'CANCELLED' AND nurst <> 'NULL' AND nurst = 'CCU'
