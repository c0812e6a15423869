"""Rate tables over two hierarchies, as Spark DataFrame operators."""
