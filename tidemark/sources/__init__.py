"""Sources and sinks: catalog tables, CSV, geometry tables, snapshots, chunked tables."""
