"""Where tables come from: schemas, readers, default mappings, the test-data adapter."""
