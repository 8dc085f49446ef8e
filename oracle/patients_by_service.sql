SELECT patno, pname, isadate, (SELECT any_value(phname) FROM phymast WHERE nwdrnum = nwattphy) AS phname
FROM patients
WHERE (hssvc, DATE '2024-01-20' - isadate) = ('RE2', 1)
