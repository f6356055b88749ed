"""Sources: tables, database connections, literal rows, lineage event documents, bindings."""
