"""Raw files, table schemas, table reads and writes."""
