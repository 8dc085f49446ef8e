SELECT oproc, hssvc, patno, pname, room, bed, nurst, osdate, stdsc, oisrdate
FROM oeorder JOIN patients ON patno = opat_no LEFT JOIN rmbed ON pat_no = patno LEFT JOIN oeostat ON stat_no = ostat
WHERE oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO') AND patno NOT IN (11, 101, 1001)
