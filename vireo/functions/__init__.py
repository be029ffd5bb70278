"""vireo.functions."""
