"""Table contracts and default constants."""
