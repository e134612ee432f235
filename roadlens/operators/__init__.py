"""DataFrame operators: aggregates, windows, ordering, joins, profiles, checks."""
