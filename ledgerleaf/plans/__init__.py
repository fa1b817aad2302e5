"""Reports, data-quality checks and metrics over the stored tables."""
