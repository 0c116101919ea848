"""Readers, writers, by-name refresh, catalog, and exports."""
