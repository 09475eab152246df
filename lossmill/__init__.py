"""Loss-ratio marts from premium and claim statistics, as plain Spark DataFrame code."""
