"""Per-layer transformations: extract, staging, facts, marts."""
