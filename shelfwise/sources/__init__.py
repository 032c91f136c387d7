"""Sources and sinks: landing JSON, parquet tables."""
