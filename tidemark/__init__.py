"""Market time-series and news-text analytics on Spark DataFrames."""
