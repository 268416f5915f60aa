"""CSV file drops, catalog tables and the adapters over the generated test tables."""
