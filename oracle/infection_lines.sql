WITH entry AS (
  SELECT nctrn.*, prval, prds FROM nctrn JOIN ncprm ON prid = trprmid WHERE prsts = 'A'),
in_house AS (
  SELECT * FROM entry JOIN rmbed ON pat_no = trpat_no JOIN patients ON patno = trpat_no
  WHERE isddate = DATE '0001-01-01' AND isadate <> DATE '0001-01-01'
    AND trrecdt >= TIMESTAMP '2024-01-19 00:00:00' AND trrecdt <= TIMESTAMP '2024-01-20 00:00:00')
SELECT nurst, room || '-' || bed AS rb, isadate, pat_no, pname, trrecdt, prval, trrecval, trcom
FROM in_house
-- Fixed value: units, parameters of central lines and of dressings, answers that name no central line.
WHERE (nurst IN ('SCUJ', 'WHBC', 'PCU', 'MCU', 'CCU', 'CDU')
       AND trprmid IN ('Q0000000163', 'Q0000004054', 'Q0000000168', 'Q0000000169', 'Q0000000667', 'Q0000000672',
                       'Q0000004013', 'Q0000004035', 'Q0000004027', 'Q0000003057')
       AND trim(trrecval) <> ''
       AND trrecval NOT IN ('Peripheral;Saline Lock', 'Peripheral;Double Lumen', 'Peripheral',
                            'Peripheral;Saline Lock;Single Lumen', 'Peripheral;Single Lumen',
                            'Peripheral;Saline Lock;Double Lumen', 'Saline Lock'))
   OR (nurst IN ('MCU', 'CCU', 'PCU', 'SCUJ', 'WHBC')
       AND trprmid IN ('Q0000004066', 'Q0000004049', 'Q0000003057', 'Q0000004030'))
