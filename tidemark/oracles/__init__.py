"""DuckDB SQL used as an independent check of the Spark queries."""
