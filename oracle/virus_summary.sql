WITH positive AS (
  -- one row per positive result of a virus order, with whatever is known of patient, bed and status
  SELECT oproc, osdate, stdsc, rtrim(rdrs) AS rdrs, patno AS patient, pname, hssvc, isadate, nurst, room, bed
  FROM oeorder JOIN rd ON (rdpt_no, rdor_no) = (opat_no, oord_no)
  LEFT JOIN patients ON patno = opat_no LEFT JOIN rmbed ON pat_no = opat_no LEFT JOIN oeostat ON stat_no = ostat
  WHERE rtrim(rdrs) = 'POSITIVE' OR starts_with(rdrs, 'POS SARS')),
dead AS (
  SELECT patno FROM patients JOIN dsstat ON dcubs = dcstat
  WHERE isddate = DATE '2024-01-19' AND dcexp = 'Y'
    AND hssvc IN ('SIP', 'MIP', 'ICU', 'GYN', 'CCU', 'PED', 'OBS', 'OBI', 'NUR')),
numbers AS (
  SELECT count(*) FILTER (oproc = 'INFLUPCR' AND rdrs = 'POSITIVE' AND hssvc <> 'EOP' AND stdsc <> 'CANCELLED' AND nurst <> 'NULL') AS flu,
         count(*) FILTER (oproc = 'INFLUPCR' AND rdrs = 'POSITIVE' AND hssvc <> 'EOP' AND stdsc <> 'CANCELLED' AND nurst <> 'NULL'
                          AND isadate = DATE '2024-01-19') AS flu_admits,
         count(*) FILTER (oproc = 'INFLUPCR' AND rdrs = 'POSITIVE' AND stdsc <> 'CANCELLED' AND nurst = 'CCU'
                          AND osdate >= 231221) AS flu_icu,
         count(*) FILTER (oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO') AND starts_with(rdrs, 'POS SARS')
                          AND patient NOT IN (11, 101, 1001) AND trim(nurst) <> '') AS virus
  FROM positive),
flu_deaths AS (
  SELECT count(*) AS n FROM dead JOIN oeorder ON opat_no = patno JOIN rd ON (rdpt_no, rdor_no) = (opat_no, oord_no)
  LEFT JOIN patrmbdp ON patn15 = patno LEFT JOIN rmbed ON pat_no = patno
  WHERE oproc = 'INFLUPCR' AND rtrim(rdrs) = 'POSITIVE'),
virus_deaths AS (
  SELECT count(*) AS n FROM dead
  WHERE patno IN (SELECT opat_no FROM oeorder WHERE oproc IN ('COVID-19', 'COVID-LC', 'COVID-QL', 'COVID-CM', 'COVID-RO'))
    AND patno IN (SELECT rdpt_no FROM rd WHERE starts_with(rdrs, 'POS SARS'))),
lines AS (
  -- Fixed value: the lines of the summary.
  SELECT unnest([
    {'metric': 'Total Flu Positives', 'value': flu},
    {'metric': 'Flu Admits Yesterday', 'value': flu_admits},
    {'metric': 'ICU Patients with Flu', 'value': flu_icu},
    {'metric': 'Total Covid and Flu Patients', 'value': virus + flu},
    {'metric': 'Deaths Yesterday with Positive Flu Test', 'value': flu_deaths.n},
    {'metric': 'Deaths Yesterday with Positive Flu or Covid Test', 'value': virus_deaths.n + flu_deaths.n}], recursive := true)
  FROM numbers, flu_deaths, virus_deaths)
SELECT metric, value FROM lines
