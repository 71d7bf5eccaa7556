"""Relational operators over DataFrames: predicates, joins, aggregates, ordering and reshaping."""
