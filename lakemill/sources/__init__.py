"""Reading: catalog tables, keyed tables, relational tables over JDBC."""
