"""Stored layers, reports and the registered queries."""
