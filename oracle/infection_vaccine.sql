WITH entry AS (
  SELECT nctrn.*, prval, prds FROM nctrn JOIN ncprm ON prid = trprmid WHERE prsts = 'A')
SELECT nurst, room, bed, patno, pname, age, trrecdt, prds, trrecval, trusr
FROM entry JOIN rmbed ON pat_no = trpat_no LEFT JOIN patients ON patno = trpat_no
WHERE trprmid IN ('Q0000000124', 'Q0000000113') AND nurst IN ('CDU', 'CVIC', 'ICU', 'SCUJ', 'WHBC', 'PCU', 'CCU', 'MCU')
  AND trim(left(trrecval, 3)) IN ('No', '', 'Una', 'Unr')
  AND trrecdt >= TIMESTAMP '2024-01-19 00:00:00' AND trrecdt < TIMESTAMP '2024-01-20 00:00:00'
