"""Data-quality rules, one module per family of campaigns."""
