"""Composed jobs: the registered query catalog, serving reads and the full
refresh."""
