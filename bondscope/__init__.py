"""Batch analytics for process-equipment telemetry, written as Spark DataFrame jobs."""
