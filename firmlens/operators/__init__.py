"""Relational operators: projections, filters, joins, aggregates, windows, top-k."""
