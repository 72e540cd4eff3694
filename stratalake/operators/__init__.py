"""DataFrame operators: shaping, filters, joins, aggregates, dedup, keys, sampling, quality."""
