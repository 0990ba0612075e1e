"""operators of the leafwave package."""
