WITH open_order AS (
  SELECT * FROM oeorder WHERE otodpt = 'LAB' AND osdate >= 240119 AND orflag <> '1'),
person AS (
  SELECT patno, pname, nurst, room, bed FROM patients LEFT JOIN rmbed ON pat_no = patno)
SELECT rmxrf AS acc, stdsc AS status, povdsc AS test, orflag AS p, rhiscldt, rhcltm, rhisrcdt, rhrctm, pname AS name, patno,
       nurst, room, bed
FROM open_order
LEFT JOIN rh ON (rhpt_no, rhor_no) = (opat_no, oord_no)
LEFT JOIN rmtor ON (rmpt_no, rmor_no) = (opat_no, oord_no)
LEFT JOIN person ON patno = opat_no
LEFT JOIN oeostat ON stat_no = ostat
LEFT JOIN oeproc ON pproc = oproc
