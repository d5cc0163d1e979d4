"""Writers: the keyed log, landed tables, the curated table."""
