"""User-level jobs, fixture views and the query registry."""
