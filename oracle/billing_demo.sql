WITH insurance AS (
  -- benefits with their extension; the extension decides only for the first one
  SELECT benefits.patno, histn, insco, benext.patno IS NOT NULL AS extended, policy, iname, reln, ibinam, ibiadr, ibiad2, ibicty, ibstat, ibarcd, ibphn1, ibphn2, ibizip
  FROM benefits LEFT JOIN benext ON benext.patno = benefits.patno AND benext.seqno = benefits.seqno),
guest AS (
  SELECT person.*, history.* EXCLUDE (ains1, ains2, ains3), phname,
         person.ains1 AS own1, if(person.ains2 = history.ains2, person.ains2, NULL) AS own2, history.ains3 AS own3
  FROM patients AS person JOIN pathist AS history ON histn = hstnum AND history.ains1 = person.ains1
  JOIN phymast ON nwdrnum = nwattphy
  WHERE isadate = DATE '2024-01-15')
SELECT guest.patno, hstnum, isadate, isddate, pname, isdob, sex, race, martl, ssn, padr1, padr2, hcity, zip, harcd, phone,
       c1nam, c1rel, c1arc, c1phn, nwattphy, phname, nwrefdoc, phname AS phname_2, diagn, nwdocnum, phname AS phname_3,
       ains1, apln1, ains2, apln2, ains3, apln3,
       i1.policy AS policy_1, i1.iname AS iname_1, i1.reln AS reln_1, i1.ibinam AS ibinam_1, i1.ibiadr AS ibiadr_1, i1.ibiad2 AS ibiad2_1, i1.ibicty AS ibicty_1, i1.ibstat AS ibstat_1, i1.ibarcd AS ibarcd_1, i1.ibphn1 AS ibphn1_1, i1.ibphn2 AS ibphn2_1, i1.ibizip AS ibizip_1,
       i2.policy AS policy_2, i2.iname AS iname_2, i2.reln AS reln_2, i2.ibinam AS ibinam_2, i2.ibiadr AS ibiadr_2, i2.ibiad2 AS ibiad2_2, i2.ibicty AS ibicty_2, i2.ibstat AS ibstat_2, i2.ibarcd AS ibarcd_2, i2.ibphn1 AS ibphn1_2, i2.ibphn2 AS ibphn2_2, i2.ibizip AS ibizip_2,
       i3.policy AS policy_3, i3.iname AS iname_3, i3.reln AS reln_3, i3.ibinam AS ibinam_3, i3.ibiadr AS ibiadr_3, i3.ibiad2 AS ibiad2_3, i3.ibicty AS ibicty_3, i3.ibstat AS ibstat_3, i3.ibarcd AS ibarcd_3, i3.ibphn1 AS ibphn1_3, i3.ibphn2 AS ibphn2_3, i3.ibizip AS ibizip_3
FROM guest
JOIN (SELECT patno AS registered FROM admreg WHERE admhsv = 'EOP') AS emergency ON registered = guest.patno
JOIN insurance AS i1 ON i1.patno = guest.patno AND i1.histn = hstnum AND i1.insco = own1 AND i1.extended
LEFT JOIN insurance AS i2 ON i2.patno = guest.patno AND i2.histn = hstnum AND i2.insco = own2
LEFT JOIN insurance AS i3 ON i3.patno = guest.patno AND i3.histn = hstnum AND i3.insco = own3
