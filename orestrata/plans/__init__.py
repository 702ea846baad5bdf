"""Compositions of operators: the whole medallion and the registered queries."""
