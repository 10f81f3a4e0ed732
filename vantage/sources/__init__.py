"""Dataset sources and sinks (Parquet) and the catalog tables derived from the driver data."""
