"""Keeping a caller's columns out of the way of an operator's own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

OWN = "__own"


def packed(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[..., list[Column]]]:
    """``docs`` with the columns in ``used`` as they are and all others in one struct, so no name of theirs can clash.

    The function that comes with it gives all columns back in their order; it
    takes names to leave out, whatever their case.
    """
    others = [c for c in docs.columns if c not in used]
    own = [F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias(OWN)] if others else []
    kept = [F.col(f"`{c}`") for c in docs.columns if c in used]

    def back(*without: str) -> list[Column]:
        gone = {w.lower() for w in without}
        place = {c: F.col(OWN)[f"c{i}"].alias(c) for i, c in enumerate(others)}
        return [place.get(c, F.col(f"`{c}`")) for c in docs.columns if c.lower() not in gone]

    return docs.select(*kept, *own), back
