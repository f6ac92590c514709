"""Writing: catalog tables, files, JDBC."""
