"""Sources and sinks: partitioned product table, report CSVs, raw payloads, pages."""
