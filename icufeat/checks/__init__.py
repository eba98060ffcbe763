"""Registered queries: each operator on the test tables, with SQL to compare to."""
