"""Column functions. Everything here is a built-in Spark expression."""
