"""Operators: cleaning, transformation, validation, reports."""
