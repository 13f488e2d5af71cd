"""Flarebook: alert notices to a dimensional model, as Spark jobs."""
