"""vireo.sources."""
