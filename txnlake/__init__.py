"""Payment-transaction ingest, reports and serving reads, written as Spark DataFrames."""
