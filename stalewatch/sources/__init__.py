"""Readers of catalog tables and of raw files."""
