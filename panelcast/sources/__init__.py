"""Input schemas, readers, writers and stage tables."""
