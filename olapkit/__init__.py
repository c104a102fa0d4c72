"""Decision-support queries, model transforms, keyed tables and metrics on Spark."""
