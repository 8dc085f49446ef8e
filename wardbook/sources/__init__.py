"""Readers: table snapshots, rosters, delimited files, table probes, stand-in views."""
