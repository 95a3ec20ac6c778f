"""Column expressions. All are built-in Spark functions; there is no Python UDF in this package."""
