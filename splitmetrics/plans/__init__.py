"""The analyses."""
