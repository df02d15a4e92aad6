"""Operators: profiling, contract checks, cleaning, features, model comparison, audit."""
