"""Versioned observation store on parquet."""

from leafwave.store.store import ObservationStore

__all__ = ["ObservationStore"]
