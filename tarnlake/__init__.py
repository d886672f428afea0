"""tarnlake: a Spark-native lakehouse, warehouse and data-quality library."""
