"""Queries over the check tables, each with the SQL that says what must come out."""
