"""Incremental processing with the file stream source."""
