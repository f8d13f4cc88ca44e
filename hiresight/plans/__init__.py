"""Composed layers and the query catalog."""
