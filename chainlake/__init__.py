"""chainlake: a Spark-native lakehouse for on-chain event logs, and the operators of a training-data pipeline."""
