WITH entry AS (
  SELECT nctrn.*, prval, prds FROM nctrn JOIN ncprm ON prid = trprmid WHERE prsts = 'A')
SELECT nurst, room, bed, isadate, pat_no, pname, trrecdt, prval, trrecval
FROM entry JOIN rmbed ON pat_no = trpat_no LEFT JOIN patients ON patno = trpat_no
-- Fixed value: units, line parameters, answers that name no central line.
WHERE trrecdt >= TIMESTAMP '2024-01-19 00:00:00' AND nurst IN ('SCUJ', 'WHBC', 'PCU', 'MCU', 'CCU', 'CDU')
  AND trprmid IN ('Q0000000163', 'Q0000004013', 'Q0000003057', 'Q0000000169', 'Q0000000168', 'Q0000000667', 'Q0000000672')
  AND NOT trrecval IN ('Peripheral;Saline Lock', 'Peripheral;Double Lumen', 'Peripheral', 'Peripheral;Saline Lock;Single Lumen',
      'Peripheral;Single Lumen', 'Peripheral;Saline Lock;Double Lumen', 'Saline Lock')
