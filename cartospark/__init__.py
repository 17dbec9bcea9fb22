"""Map-tile analytics as Spark DataFrame operations."""
