"""Writing: partitioned tables, keyed tables, relational tables, layer set-up."""
