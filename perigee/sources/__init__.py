"""Sources of the telemetry engine."""
