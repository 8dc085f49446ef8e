WITH admitted AS (
  SELECT DISTINCT opat_no FROM oeorder
  WHERE oproc IN ('ADMHOSP', 'ADMIPB1R', 'ADMIPOPR', 'ADMIP2DR', 'ADMITIP', 'ADMOBINP', 'ADMOBOBS', 'IPSCU', 'OBSERV',
                  'ERINPT', 'EROBS'))
SELECT nurst, room, bed, pname, patno
FROM rmbed JOIN patients ON patno = pat_no ANTI JOIN admitted ON opat_no = pat_no
WHERE hssvc IN ('MIP', 'SIP', 'OBS', 'OBI', 'NUR', 'BBN', 'ICU', 'CCU')
