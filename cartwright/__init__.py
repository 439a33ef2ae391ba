"""Shop data marts as Spark DataFrame operators."""
