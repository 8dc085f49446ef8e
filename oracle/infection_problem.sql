SELECT nurst, room, bed, dthpatno, pname, dthresp, dthdttm
FROM chpdtaph JOIN rmbed ON pat_no = dthpatno LEFT JOIN patients ON patno = dthpatno
WHERE dthresp = 'Isolation' AND length(trim(nurst)) > 0
