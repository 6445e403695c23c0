"""Queries over the driver tables, one per operator, and the SQL they must agree with."""
