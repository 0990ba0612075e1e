"""sources of the leafwave package."""
