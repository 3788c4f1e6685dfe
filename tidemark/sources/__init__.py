"""Table contracts, bank sources and Parquet / JDBC sinks."""
