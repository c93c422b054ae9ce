"""Registered queries: each operator bound to the given tables, with an
independent SQL statement wherever SQL can express it."""
