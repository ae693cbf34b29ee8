"""Analytics and model preparation for yearly snapshot tables, on PySpark."""
