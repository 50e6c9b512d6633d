"""Column expressions: money text, tolerance, ports, quoting."""
