"""Sales and delivery analytics as plain Spark DataFrame functions."""
