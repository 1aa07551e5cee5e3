"""Multi-row operators: positions, joins, aggregates, merges, quality, governance."""
