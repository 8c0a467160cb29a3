"""echolens - comment analytics as Spark DataFrame transformations."""
