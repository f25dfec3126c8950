"""Reading and writing retail tables."""
