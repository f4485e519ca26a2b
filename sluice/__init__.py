"""Schema-driven event engine and corpus preparation on PySpark."""
