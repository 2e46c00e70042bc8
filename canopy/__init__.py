"""Canopy: nested-document views over relational tables, kept up to date with Spark."""
