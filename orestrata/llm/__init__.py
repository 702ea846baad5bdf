"""Operators of a training-data pipeline; their queries and SQL are in `queries` and `oracle`."""
