"""Queries over the sample tables, and the SQL that must give the same rows."""
