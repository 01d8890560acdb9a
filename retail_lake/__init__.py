"""Retail sales lake on PySpark: land, conform, check, model, publish and report."""
