"""Operators for preparing training text, each one Spark job over whole tables."""
