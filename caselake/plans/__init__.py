"""Operators chained into the layers."""
