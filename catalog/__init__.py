"""Registered queries on the test tables, with their SQL equivalents."""
