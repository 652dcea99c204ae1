"""Where raw tables come from: CSV extracts or the synthetic Parquet tables."""
