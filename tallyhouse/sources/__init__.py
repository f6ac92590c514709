"""Reading: text drops, catalog tables, star-schema samples."""
