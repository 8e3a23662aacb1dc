"""Reading and writing: files, JDBC, keyed lake tables, table inventories."""
