"""Column functions: names, texts, validation. All stay inside Spark's own expressions."""
