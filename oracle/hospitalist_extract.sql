WITH discharge AS (
  SELECT *, ouser IN (SELECT 'USER' || range FROM range(0, 1000, 9)) AS by_roster FROM oeorder
  WHERE oproc IN ('DCLTCH', 'DCHOSPM', 'DCSTGHIC', 'DCAIRF', 'DCHOME', 'DCHOMEHH', 'DCHOSP', 'DCICF', 'DCIPR', 'DCSNF', 'DCACF',
                  'DCFAC', 'DCHWHH', 'DCIHOSP', 'DCOTH')),
stay AS (
  SELECT patients.*, arrvd, admhsv, dischsv FROM patients JOIN admreg USING (patno, hstnum)
  WHERE nwattphy IN (SELECT range FROM range(1, 80, 3)) AND hssvc NOT IN ('RAD', 'CAT', 'BBN', 'NUR', 'RE2', 'INF', 'LAB'))
SELECT patno AS Med_Rec_No, hstnum AS Acct_No, isdob AS Date_Of_Birth, sex AS Gender, fincl AS FinancialClass_code, fdesc AS FinancialClass_Def, isadate AS Admiss_Date, if(iatme < 1000, right('000' || CAST(iatme AS VARCHAR), 4), CAST(iatme AS VARCHAR)) AS Admiss_Time, arrvd AS Admiss_From_Definition, isddate AS Discharge_Date, dtime AS Discharge_Time, referring.phname AS Admitting_Phys, attending.phname AS Attending_Phys, split_part(odobtx, '{', 1) AS Discharging_Phys, oedate AS DC_Order_Date, oetime AS DC_Order_Time, oproc AS DC_Dispo_Def, drg AS MSDRG_code, drgdes AS MSDRG_Code_Des, diag9 AS ICD1, if(isddate = DATE '0001-01-01', NULL, isddate - isadate) AS LengthOfStay, admhsv AS PtStatus_Admission, dischsv AS PtStatus_Dicharge,
       CAST(NULL AS VARCHAR) AS ED_Arrival_Date, CAST(NULL AS VARCHAR) AS ED_Arrival_Time, CAST(NULL AS VARCHAR) AS ED_Dispo_Date, CAST(NULL AS VARCHAR) AS ED_Dispo_Time, CAST(NULL AS VARCHAR) AS ED_Depart_Time, CAST(NULL AS VARCHAR) AS Admiss_From_Code, CAST(NULL AS VARCHAR) AS DC_Dispo_Code, CAST(NULL AS VARCHAR) AS Discharge_Unit, CAST(NULL AS VARCHAR) AS APRDRG_Code, CAST(NULL AS VARCHAR) AS APRDRG_Desc, CAST(NULL AS VARCHAR) AS ICD2, CAST(NULL AS VARCHAR) AS ICD3, CAST(NULL AS VARCHAR) AS ICU_Stay, CAST(NULL AS VARCHAR) AS Cost_Total, CAST(NULL AS VARCHAR) AS Cost_Direct_Rad, CAST(NULL AS VARCHAR) AS Cost_Direct_Pharm, CAST(NULL AS VARCHAR) AS Cost_Direct_Lab
FROM discharge JOIN stay ON patno = opat_no
LEFT JOIN phymast AS referring ON referring.nwdrnum = nwrefdoc LEFT JOIN phymast AS attending ON attending.nwdrnum = nwattphy
LEFT JOIN fcdesc ON fcfincl = fincl LEFT JOIN drgdesc USING (drg) LEFT JOIN username ON odobnm = ouser
WHERE DATE '2024-01-20' - isadate <= 32 OR (by_roster AND oedate >= 231219)
