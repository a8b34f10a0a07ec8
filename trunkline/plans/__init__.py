"""Loads over a warehouse, and the registered queries."""
