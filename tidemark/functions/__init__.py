"""Column functions: time, strings, aggregates and their SQL registrations."""
