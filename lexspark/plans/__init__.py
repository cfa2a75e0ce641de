"""Plan helpers: lineage cuts, size checks, spreading, global order."""
