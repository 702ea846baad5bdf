"""Scans: files, tables, JDBC, and text rows checked against a contract."""
