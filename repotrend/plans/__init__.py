"""Composite plans: data-quality checks, the gated end-to-end run."""
