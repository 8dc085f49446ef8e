WITH move AS (
  SELECT patn15 AS patno, room, asgdate, CAST(hour(asgtime) AS BIGINT) AS asgtime FROM patrmbdp
  WHERE DATE '2024-01-20' - asgdate BETWEEN 0 AND 27
    -- Fixed value: rooms that are none.
    AND room NOT IN (
      'VMCU', 'HALL', 'VCDU', 'VCCU', 'VOR', 'VSCJ', 'VPCU', 'VSSU', 'VCVP', '1', '2', '3', '4', '5', '6', '7', '8',
      '9', '10', '11', '12', '13', '14', '15', '16', '17', 'S01', 'S02', 'S03', 'S04', 'S05', 'S06', 'S07', 'S08',
      'S09', 'S10', 'S11', 'S12', 'S13', 'S14', 'S15', 'S16', 'S17', 'S18', 'S19', 'S20', 'S21', 'S22', 'S23', 'S24',
      'S25', 'S26', 'S27', 'S28', 'S29', 'S30', 'S31', 'S32', 'S33', 'S34', 'S35', 'S36', 'S37', 'S38', 'S39', 'S40',
      'SER1', 'SER2')),
last_rows AS (
  SELECT patno, isadate, iatme, hssvc, room, asgdate, asgtime, nurst
  FROM patients JOIN move USING (patno) JOIN rmbed USING (room)
  WHERE DATE '2024-01-20' - isadate BETWEEN 0 AND 27
    AND hssvc NOT IN ('GIO', 'SOP', 'CAT', 'WCC', 'LAB', 'OS1', 'RE2', 'RAD', 'INF', 'CAR', 'MOP', 'REF')
  QUALIFY row_number() OVER (
    PARTITION BY patno
    ORDER BY isadate DESC, iatme DESC, asgdate DESC, asgtime DESC, room DESC, nurst DESC NULLS LAST) = 1)
SELECT * FROM last_rows
