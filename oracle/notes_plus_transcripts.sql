WITH author AS (
  FROM (VALUES ('Supplier#00000000'), ('Supplier#00000001'), ('Supplier#000000012'), ('Supplier#00000004'), ('Supplier#000000045'))
  AS a(prefix)),
document AS (
  SELECT patient_id AS mrn, encid AS account_number, crtdname AS physician, titl AS document, createdt AS document_date
  FROM cdnotetb JOIN author ON starts_with(crtdname, prefix)
  UNION ALL
  SELECT dhhstno, dhpatno, phname, dhfldr, dhdate
  FROM trdochp LEFT JOIN phymast ON nwdrnum = dhdrno
  WHERE dhdrno IN (SELECT range FROM range(2, 60, 7)))
SELECT document.*, pname AS patient_name
FROM document LEFT JOIN patients ON (patno, hstnum) = (account_number, mrn)
WHERE DATE '2024-01-20' - document_date BETWEEN 0 AND 7
