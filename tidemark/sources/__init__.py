"""Table readers, declared schemas, shaped inputs and the snapshot store."""
