"""Compositions of operators: the cleaning chain, the model table, the query catalogue."""
