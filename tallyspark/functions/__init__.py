"""Column-level helpers: money arithmetic, date predicates, CASE ladders."""
