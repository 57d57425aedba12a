"""Readers: landing feeds, stored layers, and bars made from trades or events."""
