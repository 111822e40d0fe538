"""Registered queries and their SQL for a second engine."""
