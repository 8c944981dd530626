"""Scalar functions of the telemetry engine, as Spark expressions without Python UDFs."""
