"""Reading raw exports and layer tables, writing layer tables."""
