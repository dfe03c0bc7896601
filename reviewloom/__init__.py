"""Customer-review data engine on Spark: DataFrame in, DataFrame out."""
