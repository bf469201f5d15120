"""Column expressions: geometry, measurements, dates."""
