"""Registered queries over the test tables, with a plain-SQL twin for each."""
