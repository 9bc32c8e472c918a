"""Column expressions shared by the DataFrame and SQL paths (``columns``)."""
