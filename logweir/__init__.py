"""Network-log anomaly analytics on Spark."""
