"""DataFrame operators: filters, joins, aggregates, percentiles, windows, sessions, merges, checks."""
