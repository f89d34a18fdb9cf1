"""Sources and sinks: CSV, parquet tables, inference logs, profiles, payloads."""
