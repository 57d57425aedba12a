"""Incremental loading of a landing folder."""
