"""api of the leafwave package."""
