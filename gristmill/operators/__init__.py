"""DataFrame operators: rules, joins, aggregations and positional work."""
