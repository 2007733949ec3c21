"""Student reporting tables as Spark DataFrame operators and plans."""
