"""Column expressions. All are built-in Spark expressions; none is a Python UDF."""
