"""ticklake: a Spark-native market-tick lakehouse."""
