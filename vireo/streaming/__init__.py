"""vireo.streaming."""
