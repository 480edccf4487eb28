"""turnstile: Spark-first reporting engine for visit-based services."""
