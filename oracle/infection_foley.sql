WITH entry AS (
  SELECT nctrn.*, prval, prds FROM nctrn JOIN ncprm ON prid = trprmid WHERE prsts = 'A')
SELECT nurst, room || '-' || bed AS rb, isadate, pat_no, pname, trrecdt, trrecval, trcom
FROM entry JOIN rmbed ON pat_no = trpat_no LEFT JOIN patients ON patno = trpat_no
WHERE trprmid IN ('Q0000000382', 'Q0000004576') AND nurst IN ('CDU', 'CVIC', 'ICU', 'SCUJ', 'WHBC', 'PCU', 'CCU', 'MCU')
  AND trrecval NOT IN ('Voiding', 'Incontinent', 'Other-See Comment', 'Straight Catheter')
  AND trrecdt >= TIMESTAMP '2024-01-19 00:00:00' AND trrecdt <= TIMESTAMP '2024-01-20 00:00:00'
