"""Queries over the test tables, and the SQL that has to give the same rows."""
