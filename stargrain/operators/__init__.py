"""DataFrame-to-DataFrame operations: calendar, dimensions, facts, profiling, quality, metrics."""
