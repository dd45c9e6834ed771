"""recordloom: adaptive record analytics expressed as Spark DataFrame operations."""
