"""Table schemas, readers, sinks and the retail views over the TPC-H-like test tables."""
