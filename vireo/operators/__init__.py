"""vireo.operators."""
