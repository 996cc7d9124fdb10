"""Composite products (the report layers) and the query catalog."""
