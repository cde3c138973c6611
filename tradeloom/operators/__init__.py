"""Reusable relational building blocks shared by the reports."""
