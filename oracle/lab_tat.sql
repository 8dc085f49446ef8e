WITH early AS (
  SELECT * FROM oeorder WHERE osdate = 240120 AND ostime <= 400 AND otodpt <> 'RAD')
SELECT opty, oproc, nurst, oord_no, opat_no, osdate, rhiscldt, rhtc, rhisrndt, rhisvfdt, rhrcby,
       CASE WHEN ostime BETWEEN 0 AND 2359 AND ostime % 100 < 60 THEN format('{:02d}:{:02d}:00', ostime // 100, ostime % 100) END AS stime,
       CASE WHEN rhcltm BETWEEN 0 AND 2359 AND rhcltm % 100 < 60 THEN format('{:02d}:{:02d}:00', rhcltm // 100, rhcltm % 100) END AS ctime,
       CASE WHEN rhrntm BETWEEN 0 AND 2359 AND rhrntm % 100 < 60 THEN format('{:02d}:{:02d}:00', rhrntm // 100, rhrntm % 100) END AS rtime,
       CASE WHEN rhvftm BETWEEN 0 AND 2359 AND rhvftm % 100 < 60 THEN format('{:02d}:{:02d}:00', rhvftm // 100, rhvftm % 100) END AS vtime
FROM early JOIN rh ON (rhpt_no, rhor_no) = (opat_no, oord_no) LEFT JOIN rmbed ON pat_no = opat_no
