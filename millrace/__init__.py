"""Analytics jobs written as DataFrame-to-DataFrame functions for PySpark."""
