"""Operators for preparing training data: ten Spark operators over document,
benchmark, page and conversation tables, and the queries that apply them.

Nothing else in the library imports this subpackage."""
