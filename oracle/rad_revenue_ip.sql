WITH charge AS (
  SELECT * FROM accumchg
  WHERE dept IN (161, 162, 163, 164, 281) AND DATE '2024-01-20' - ispdatea BETWEEN 1 AND 62
    AND svccd NOT IN (2811277, 2811241, 2811255, 2811167, 2811256, 2811238, 2811243))
SELECT ispdatea, dept, gldesc, patno, pname, hssvc, charge.isdate, svccd, chrgdesc.desc, qty, qty AS qty_2, amt1
FROM charge JOIN patients USING (patno) LEFT JOIN chrgdesc USING (svccd) LEFT JOIN glkeysm ON deptg = dept
WHERE rectyp <> 'I'
