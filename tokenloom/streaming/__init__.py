"""tokenloom streaming."""
