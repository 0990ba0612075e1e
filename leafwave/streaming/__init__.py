"""streaming of the leafwave package."""
