"""Plan-level helpers: lineage cuts and table access."""
