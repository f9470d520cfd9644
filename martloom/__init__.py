"""Commerce and marketing analytics as Spark DataFrame transformations."""
