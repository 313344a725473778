"""Reports and jobs."""
