"""tokenloom sources."""
