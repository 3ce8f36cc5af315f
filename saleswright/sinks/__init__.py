"""Writing cleaned data, tables and reports."""
