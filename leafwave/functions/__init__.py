"""functions of the leafwave package."""
