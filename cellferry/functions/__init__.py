"""Column expressions. Nothing in this package starts a job or uses a Python UDF."""
