"""Water-station telemetry analytics on Spark DataFrames."""
