"""Writers: partitioned tables, upserts and JSON lines."""
