"""tokenloom functions."""
