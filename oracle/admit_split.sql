WITH arrival AS (SELECT * FROM patients WHERE DATE '2024-01-20' - isadate = 1)
SELECT if(hssvc = 'OBS', 'OBS', 'inpatient') AS section, hssvc, patno, pname, isadate, room, bed, nurst
FROM rmbed JOIN arrival ON patno = pat_no
WHERE nurst IS NOT NULL AND nurst <> 'NULL' AND hssvc IS NOT NULL
