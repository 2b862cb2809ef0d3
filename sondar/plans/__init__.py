"""Physical-plan helpers: lineage cuts, size estimates, table loading."""
