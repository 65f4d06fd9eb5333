"""Market-data analytics on Spark: normalise, plan, store, check and query exchange time series."""
