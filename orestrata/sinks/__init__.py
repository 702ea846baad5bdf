"""Materialization: tables, views, versioned folders and keyed upserts."""
