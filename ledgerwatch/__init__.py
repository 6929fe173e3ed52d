"""Transaction-risk analytics on Spark: scoring, alerts, analytics and streams."""
