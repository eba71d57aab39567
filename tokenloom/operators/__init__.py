"""tokenloom operators."""
