"""Incremental (file-stream) extraction of newly landed hours."""
