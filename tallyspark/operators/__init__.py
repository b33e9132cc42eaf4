"""Operators: profiling, cleaning, relational helpers, ranking and data quality."""
