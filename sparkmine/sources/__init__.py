"""Sources and sinks: parquet tables and the text layouts of the original jobs."""
