"""canonlake: a Spark-native engine for a two-layer data lake, entity resolution and derived analytics."""
