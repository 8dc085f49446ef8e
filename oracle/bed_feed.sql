SELECT '2024-01-20T00:00Z' AS "Timestamp of record", 'General Hospital' AS "System", 'General Hospital' AS "Facility",
       nurst AS "Unit", room AS "Room", bed AS "Bed", pat_no <> 0 AS "isOccupied", false AS "isBlocked", false AS "isVentCapable"
FROM rmbed
WHERE bed IS DISTINCT FROM 'P' AND nurst IS DISTINCT FROM 'NUR'
