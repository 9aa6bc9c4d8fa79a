"""Report queries: each takes a Floor and returns an ordered DataFrame."""
