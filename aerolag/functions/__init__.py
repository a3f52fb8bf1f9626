"""Column -> Column helpers made of built-in Spark expressions."""
