"""Sources: the driver's parquet tables, the views derived from them and
generated period spines."""
