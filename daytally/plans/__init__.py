"""Registered queries: Spark plans over the test tables, and the SQL each must equal."""
