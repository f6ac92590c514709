"""Column expressions: parsing, codes, keys and text formats."""
