WITH noted AS (
  SELECT patno FROM patients JOIN cdnotetb ON encid = patno
  WHERE starts_with(titl, 'Coronavirus') AND isadate > DATE '2023-12-31'),
listed AS (
  SELECT pat_no, isadate, nurst, room, bed FROM rmbed LEFT JOIN patients ON patno = pat_no
  WHERE pat_no > 0 AND nurst NOT IN ('DIAG', 'NUR', 'WHBC', 'CVPR', 'EOP'))
SELECT * FROM listed SEMI JOIN noted ON patno = pat_no
