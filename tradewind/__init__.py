"""Commerce sales joined with economic indicators, as plain Spark DataFrame functions."""
