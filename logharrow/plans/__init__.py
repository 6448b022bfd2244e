"""Composed plans and the driver's queries."""
