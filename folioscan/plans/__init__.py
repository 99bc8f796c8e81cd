"""Named queries with their oracle SQL."""
