WITH noted AS (
  SELECT patno FROM patients JOIN cdnotetb ON encid = patno
  WHERE starts_with(titl, 'Coronavirus') AND isadate > DATE '2023-12-31'),
listed AS (
  SELECT pat_no, isadate, nurst, room, bed FROM rmbed LEFT JOIN patients ON patno = pat_no
  WHERE pat_no > 0 AND nurst NOT IN ('DIAG', 'NUR', 'WHBC', 'CVPR', 'EOP')),
unit AS (FROM (VALUES ('CCU', 1), ('CDU', 2), ('MCU', 3), ('PCU', 4), ('SCUJ', 5)) AS u(name, place))
SELECT coalesce((SELECT arg_min(name, place) FROM unit WHERE contains(nurst, name)), 'SSU') AS section, listed.*
FROM listed ANTI JOIN noted ON patno = pat_no
