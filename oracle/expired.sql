WITH dead AS (
  SELECT * FROM patients JOIN dsstat ON dcubs = dcstat WHERE dcexp = 'Y' AND isddate = DATE '2024-01-19')
SELECT hssvc, patno, pname, age, sex, isadate, iatme, diagn, isddate, dtime, dcsds, dcexp, place.room, place.bed
FROM patrmbdp AS place JOIN dead ON patno = place.patn15
WHERE place.recid = 'Y'
