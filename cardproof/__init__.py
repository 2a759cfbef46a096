"""Card-transaction integrity and fraud analytics on PySpark."""
