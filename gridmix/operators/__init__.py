"""DataFrame-level operators (joins, aggregations, windows, sets, quality checks)."""
