"""Readers and writers for archives, manifests, JSON lines and the corpus."""
