"""Registered queries over the given tables, each next to the SQL that checks it."""
