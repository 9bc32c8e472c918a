"""Independent SQL used to check the Spark results."""
