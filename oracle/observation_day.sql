SELECT patno, adate, iatme, isqadte, iqtime, nwdocnum, hssvc, atype, asrce, age, fincl, pname, arrvd, diagn, hstnum
FROM patients LEFT JOIN (SELECT patno, hstnum, atype, asrce, arrvd FROM admreg) AS registration USING (patno, hstnum)
WHERE hssvc = 'OBS' AND DATE '2024-01-20' - isadate = 1
