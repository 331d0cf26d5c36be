"""Trip analytics as plain DataFrame functions on PySpark."""
