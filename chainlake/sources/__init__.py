"""Sources and sinks: raw logs, Kafka, Parquet with discovery, manifest and atomic publishing."""
