"""vireo.plans."""
