"""perigee: spacecraft telemetry analytics expressed as Spark DataFrame, SQL and Structured Streaming work."""
