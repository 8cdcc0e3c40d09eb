"""Jobs, served queries, checks and alerts."""
