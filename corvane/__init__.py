"""corvane: a Spark-native engine for collecting, curating and ranking attributed publications."""
