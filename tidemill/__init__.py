"""A Spark-first engine for event features, training sets and their streams."""
