"""Report plans over the lake tables."""
