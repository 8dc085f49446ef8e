WITH author AS (
  -- Every note of an author on the list, once for each edit by its writer, or once without any.
  FROM (VALUES ('Supplier#00000000'), ('Supplier#00000001'), ('Supplier#000000012'), ('Supplier#00000004'), ('Supplier#000000045'))
  AS a(prefix)),
edit AS (
  SELECT enctrid AS encid, lstmodby AS createby FROM cdnteatb)
SELECT prefix AS section, hssvc, hstnum, encid, pname, isdob, titl, createdt, crtdname
FROM cdnotetb JOIN author ON starts_with(crtdname, prefix) JOIN patients ON patno = encid LEFT JOIN edit USING (encid, createby)
WHERE DATE '2024-01-20' - createdt BETWEEN 0 AND 14
