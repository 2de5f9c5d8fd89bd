"""Game-telemetry jobs on Spark."""
