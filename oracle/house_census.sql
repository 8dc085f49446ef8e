WITH person AS (
  SELECT patients.*, phymast.phname FROM patients LEFT JOIN phymast ON nwdrnum = nwdocnum)
SELECT nurst, room, bed, observ, pname, age, diagn, phname
FROM rmbed LEFT JOIN person ON patno = pat_no
WHERE pat_no > 0 AND nurst NOT IN ('SSU', 'EOP')
