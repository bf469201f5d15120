"""DataFrame operators that Spark has no single primitive for."""
