WITH missing AS (
SELECT nurst, room, bed, pname, patno
FROM rmbed JOIN patients ON patno = pat_no
WHERE pat_no NOT IN (
  SELECT DISTINCT opat_no FROM oeorder
  WHERE oproc IN ('ADMHOSP', 'ADMIPB1R', 'ADMIPOPR', 'ADMIP2DR', 'ADMITIP', 'ADMOBINP', 'ADMOBOBS', 'IPSCU', 'OBSERV',
                  'ERINPT', 'EROBS'))
  AND hssvc IN ('MIP', 'SIP', 'OBS', 'OBI', 'NUR', 'BBN', 'ICU', 'CCU'))
SELECT unnest(['MISSING ADMIT ORDERS For 2024-01-20', '===============================================', '', '',
  'Nurse St      Room         Bed     Patient Name             Account Number', '']) AS value
UNION ALL
SELECT concat(ifnull(nurst, 'None'), repeat(' ', 6), ifnull(room, 'None'), repeat(' ', 9), ifnull(bed, 'None'), repeat(' ', 5),
              ifnull(pname, 'None'), repeat(' ', 13), patno)
FROM missing
