"""Presets for the credit schema and the catalogue of checked queries."""
