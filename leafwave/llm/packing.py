"""Packing tokenised documents into sequences: bounded-space online best-fit.

A document becomes its token ids and an end id; one longer than a sequence is
cut into full pieces and a last, shorter one. Tokenising runs where the texts
are read and yields narrow rows (no texts, no ids); these are dealt by a hash
and sorted by it, which mixes long and short pieces and makes every retry pack
alike. Spark then merges small partitions, so the number of packers follows
the number of pieces.

Each packer takes pieces in turn, the longest of the next few first, and holds at most ``open_bins`` sequences. A
bitset with one bit for every amount of free space says which amounts occur
among them, so the best fit, the least free space that is enough, is the lowest
set bit from the piece's length up. If nothing fits, a new sequence is opened;
when there would be too many, the fullest one, the lowest bit of all, closes
first. Full sequences close at once. Memory is bounded by ``open_bins``; what
is lost are the few unfilled sequences at each packer's end.

Null and empty texts count as the end id alone. Repeated rows are packed each
on its own. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leafwave.llm.common import kept_in_worker, only

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 4096
#: Pieces a packer holds back to place the longest of them first.
LOOKAHEAD = 2000
#: Chunks a worker remembers before it starts over; about 200 MB.
REMEMBERED = 1_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Packing:
    length: int = SEQUENCE
    open_bins: int = OPEN_BINS
    lookahead: int = LOOKAHEAD


class ChunkIds(dict):
    """Ids, as little-endian bytes, of text chunks without white space; made when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self[""] = b""

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
                self[""] = b""
            self[chunk] = ids
        return ids


def encoder(path: str):
    """A function from a text to its ids as little-endian bytes, equal to the tokenizer's on the whole text.

    The tokenizer lower-cases, drops white space and never merges across it, nor
    across the start of a run of punctuation after a letter or digit. So a text
    may be cut there and each chunk's ids be remembered. Texts with letters
    whose lower case is not one letter of its own, or with the opening of a
    special token, are only cut at white space.
    """
    import re

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    chunks = ChunkIds(tokenizer)
    before_marks = re.compile(r"(?<=[^\W_])(?=[.,;:!?%&*$#|])")

    def encode(text: str) -> bytes:
        if not any(x in text for x in ("<|", "Σ", "İ")):
            text = before_marks.sub(" ", text.lower())
        return b"".join(map(chunks.__getitem__, text.replace("\n", " ").split(" ")))

    return encode


def pieces_of(ids: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids, the end id included."""
    step = 4 * length
    return [
        (i, at // 4, len(part) // 4, zlib.crc32(part))
        for i, at in enumerate(range(0, len(ids), step))
        for part in (ids[at : at + step],)
    ]


def cut(docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE) -> DataFrame:
    """One row per piece of every document."""

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = kept_in_worker(f"encoder of {tokenizer_path}", lambda: encoder(tokenizer_path))
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = [
                (doc, *piece)
                for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"])
                for piece in pieces_of((encode(text) if isinstance(text, str) else b"") + end, length)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return only(docs, doc_id="doc_id", text="text").mapInPandas(tokenise, PIECES)


class OpenBins:
    """At most ``most`` open sequences, found by free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.free = 0  # bit f: some open sequence has f places left
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.n_open = 0
        self.n_all = 0

    def place(self, need: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``need`` ids."""
        fitting = self.free >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.n_open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            space, sequence = self.length, self.n_all
            self.n_all += 1
        left = space - need
        if left:
            self.by_free[left].append(sequence)
            self.free |= 1 << left
            self.n_open += 1
        return sequence, self.length - space

    def _take(self, space: int) -> int:
        held = self.by_free[space]
        sequence = held.pop()
        if not held:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return sequence


def pack(docs: DataFrame, tokenizer_path: str, how: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``."""
    places = "sequence_id long, offset long"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenBins(how.length, how.open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = batch["length"].to_numpy()
            turns = np.lexsort((-size, np.arange(len(size)) // how.lookahead))
            out = batch.drop(columns="dealt").astype({"doc_id": "Int64"}).iloc[turns]
            placed = [bins.place(int(n)) for n in size[turns]]
            out["sequence_id"] = [first + s for s, _ in placed]
            out["offset"] = [o for _, o in placed]
            yield out

    dealt = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    pieces = cut(docs, tokenizer_path, how.length).withColumn("dealt", dealt)
    ordered = pieces.repartition("dealt").sortWithinPartitions("dealt", "doc_id", "piece")
    return ordered.mapInPandas(fill, f"{PIECES}, {places}")
