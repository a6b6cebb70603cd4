"""Reports, the semantic model and whole jobs."""
