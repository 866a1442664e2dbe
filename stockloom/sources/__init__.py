"""Table schemas, readers and writers, and the adapter from the star-schema test tables."""
