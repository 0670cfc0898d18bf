"""Writers: the Parquet warehouse and text outputs."""
