"""The three entry points: gate a hand-off, prepare a table, compare feature sets."""
