WITH author AS (
  FROM (VALUES ('Supplier#00000000'), ('Supplier#00000001'), ('Supplier#000000012'), ('Supplier#00000004'), ('Supplier#000000045'))
  AS a(prefix)),
edited AS (
  SELECT enctrid AS encid, lstmodby AS createby, count(*) AS times FROM cdnteatb GROUP BY ALL)
SELECT prefix AS section, hssvc, hstnum, encid, pname, isdob, titl, createdt, crtdname, ifnull(times, 1) AS copies
FROM cdnotetb JOIN author ON starts_with(crtdname, prefix) JOIN patients ON patno = encid LEFT JOIN edited USING (encid, createby)
WHERE DATE '2024-01-20' - createdt BETWEEN 0 AND 2
