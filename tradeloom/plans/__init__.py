"""The reports."""
