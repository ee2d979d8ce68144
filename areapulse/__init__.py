"""Regional activity analytics expressed as Spark DataFrame transformations."""
