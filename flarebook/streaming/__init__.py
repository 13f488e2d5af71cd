"""Structured Streaming jobs between the layers."""
