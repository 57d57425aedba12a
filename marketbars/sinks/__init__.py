"""Writers of the stored layers."""
