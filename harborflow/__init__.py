"""harborflow: vessel-tracking analytics expressed as Spark DataFrame jobs."""
