"""SQL forms of the jobs, end-to-end jobs, and the registered driver queries."""
