"""Column-level helpers: measures, text and rounding rules."""
