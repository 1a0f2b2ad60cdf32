"""Queries over the test tables: one per operator, with the SQL that must give the same rows."""
