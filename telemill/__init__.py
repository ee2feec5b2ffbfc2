"""telemill: Spark jobs for device telemetry and predictive maintenance."""
