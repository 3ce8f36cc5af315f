"""Reading order tables: files, databases, previously cleaned data."""
