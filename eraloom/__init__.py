"""Era analytics on Spark: DataFrame operators for era-grouped prediction tables."""
