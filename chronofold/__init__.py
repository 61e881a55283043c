"""Dimension history, nested records and skew-safe relational helpers on Spark."""
