WITH entry AS (
  SELECT nctrn.*, prval, prds FROM nctrn JOIN ncprm ON prid = trprmid WHERE prsts = 'A')
SELECT nurst, room || '-' || bed AS rmbed, pat_no, pname, trrecval, trrecdt
FROM entry JOIN rmbed ON pat_no = trpat_no JOIN patients ON patno = pat_no
WHERE trprmid = 'Q0000005455' AND nurst IN ('CDU', 'CVIC', 'ICU', 'SCUJ', 'WHBC', 'PCU', 'CCU', 'MCU')
  AND NOT trrecval = 'Standard Isolation - Universal Precautions'
  AND trrecdt >= TIMESTAMP '2024-01-19 16:00:01' AND trrecdt < TIMESTAMP '2024-01-20 00:00:00'
