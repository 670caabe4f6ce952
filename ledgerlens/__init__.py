"""Payment audit analytics as Spark DataFrame transformations."""
