WITH waiting AS (
  SELECT * FROM oeorder
  WHERE ostat = 3 AND oinit <> 'Y'
    -- Fixed value: respiratory orders.
    AND oproc IN ('ABGCAPI', 'ABGCORDV', 'AP', 'ABGCORDA', 'ABGELGLU', 'RSV', 'FLU/RVP', 'RESPDFA', 'BORDPER', 'BPRTAB',
                  'ABGERPNL', 'ABGORPNL', 'ABGO2SAT', 'ABGVENBL', 'CULRSP', 'CARBONM', 'FLU/PCR', 'FLUABAB', 'FLUABAG',
                  'FLUEABPCR', 'HINFBIGG', 'INFABDFA', 'FLUPCR', 'INFLUAB', 'INFLUWOP', 'RVPPCR', 'SPECCOLL', 'RVP PCR',
                  'FLUPCRAB', 'INFLUPCR', 'RVPPCREX', 'CULRESP', 'CULLRES', 'CULAFBPL', 'RVP-PCR', 'COVID-19', 'COVID-QL',
                  'COVID-LC', 'COVID-CM', 'COVID-RO'))
SELECT nurst, room || '-' || bed AS rb, patno, pname, osdate, ostime, oord_no, oproc, povdsc
FROM waiting JOIN rmbed ON pat_no = opat_no JOIN patients ON patno = opat_no LEFT JOIN oeproc ON pproc = oproc
WHERE nurst IN ('CDU', 'CVIC', 'ICU', 'SCUJ', 'WHBC', 'PCU', 'CCU', 'MCU')
