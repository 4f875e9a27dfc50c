"""Column expressions; all of them built-in, none a Python UDF."""
