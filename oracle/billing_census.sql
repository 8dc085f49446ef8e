WITH emergency AS (SELECT patno, hstnum, nwdrnum FROM admreg WHERE admhsv = 'EOP')
SELECT isadate, iatme, isddate, dtime, pname, age, sex, padr1, dcstat, diagn, phname, nwdrnum, hstnum, patno, isdob
FROM patients JOIN emergency USING (patno, hstnum) JOIN phymast USING (nwdrnum) JOIN pathist ON histn = hstnum
WHERE DATE '2024-01-20' - isadate = 1
