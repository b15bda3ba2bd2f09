"""Sources: the driver's test tables, the generator's JSON documents, landed Parquet."""
