SELECT CASE WHEN line = 0 THEN t1.room END AS room, CASE WHEN line = 0 THEN t1.bed END AS bed,
       CASE WHEN line = 0 THEN t1.pat_no END AS pat_no, CASE WHEN line = 0 THEN t2.pname END AS pname,
       CASE WHEN line = 0 THEN t2.diagn END AS diagn, line
FROM rmbed t1
LEFT JOIN patients t2 ON t1.pat_no = t2.patno
CROSS JOIN (VALUES (CAST(0 AS INT)), (1), (2)) AS lines(line)
WHERE t1.nurst = 'CCU' AND t1.pat_no > 0
