"""Reading and writing of the canonical tables."""
