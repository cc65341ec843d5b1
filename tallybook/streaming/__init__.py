"""Books as they arrive."""
