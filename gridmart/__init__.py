"""Star-schema loading and race-results analytics as plain Spark DataFrame jobs."""
