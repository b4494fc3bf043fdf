"""Sources and sinks: grids from files, seeds, landed objects, table-derived extracts."""
