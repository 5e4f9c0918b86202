"""Scans and sinks (delimited files, JDBC, catalog tables), fixed file
schemas, and the mapping of the driver's tables onto tap and station tables."""
