"""Registered queries: each operator on the given tables, with the SQL that checks it."""
