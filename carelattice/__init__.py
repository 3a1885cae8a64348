"""Clinical and eligibility analytics as Spark DataFrame operators and streaming jobs."""
