"""Landing zone and tables."""
