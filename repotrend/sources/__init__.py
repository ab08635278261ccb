"""Inputs and outputs: feed binding, raw landing/scan, manifests, tables."""
