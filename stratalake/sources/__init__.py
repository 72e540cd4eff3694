"""Sources and sinks: raw CSV, file drops, the Parquet lake, stored tables, the serving copy."""
