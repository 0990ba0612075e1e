"""Byte-level BPE over distinct words: split, number, encode each word once, join back.

Texts are split into pre-tokens. Consecutive documents of a partition form a
block, and within a block every pre-token becomes the number of its word, so a
document is a short list of numbers by position. The words of all blocks are
then shuffled by word; each distinct word of the corpus meets its other
mentions in one place and is encoded once. Its ids are exploded with their
positions, joined with the token-byte table, which decodes them, and put
together again by position. Ids and bytes go back to the blocks that hold the
word, many words of a block in one row, and there each document is put together
by the positions of its words: its ids, and the bytes the ids stand for.

Documents move once, as compressed numbers, and words move once per block
instead of once per mention, so a word as common as a space costs one row per
block. A block ends at ``Blocks.text_bytes`` of text or ``Blocks.words``
different words, whichever comes first, which bounds what a task holds; a
single longer text makes a block of its own. A text that a block holds again is
not split again. The token-byte table has as many rows as the vocabulary file
and is broadcast.

The split is evaluated once for the words and once for the numbers, so ``docs``
has to give the same rows in the same partitions each time, as a scan of files
does; write anything else first (``common.saved``). The decoded bytes of every
document are compared with a checksum of its text, so an input that breaks
this ends in an error instead of wrong ids.

Null and empty texts have no ids and decode to nothing. Very long texts are
encoded whole. Repeated rows and ids give a row each; other columns are never
looked at. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.llm.common import kept_in_worker, only


#: Mentions of words by blocks that a task holds before it packs them, and those that one row carries.
HELD, PLACES = 400_000, 4_096


@dataclass(frozen=True)
class Blocks:
    text_bytes: int = 64 << 20
    words: int = 1 << 20


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, from a file with a base64 token and its id in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(i) for token, i in map(bytes.split, lines)}


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table: one row per entry of the vocabulary file."""
    return spark.createDataFrame([(i, t) for t, i in ranks(path).items()], "id int, bytes binary")


# -- splitting ------------------------------------------------------------------


def pack(numbers: list[int] | np.ndarray) -> bytes:
    """Numbers as one compressed value: all low bytes first, then the next higher ones."""
    return zlib.compress(np.array(numbers, "<u4").view("u1").reshape(-1, 4).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), "u1").reshape(4, -1).T).view("<u4").ravel()


def ragged(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``start``, one after the other."""
    first = np.cumsum(length) - length
    return values[np.repeat(start - first, length) + np.arange(length.sum())]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern``; plain ASCII texts go to the standard library, where its classes are known to mean the same."""
    import regex

    whole = regex.compile(pattern).findall
    plain = pattern.replace("[^\\s\\p{L}\\p{N}]", "[^\\sA-Za-z0-9]").replace("\\p{L}", "[A-Za-z]").replace("\\p{N}", "[0-9]")
    if "\\p" in plain:
        return whole
    ascii_only = re.compile(plain, re.ASCII).findall
    return lambda text: ascii_only(text) if text.isascii() else whole(text)


def blocks(batches: Iterator[pa.RecordBatch], pattern: str, bounds: Blocks) -> Iterator[tuple[int, object, str, bytes, list[int] | None, dict[str, int]]]:
    """(block, doc_id, text, key, word numbers, the block's words so far) for each document; a text met before in its block has
    no word numbers, but the key of that one."""
    split = splitter(pattern)
    block, size = None, 0

    def fresh() -> tuple[dict[str, int], set[bytes]]:
        numbers: dict[str, int] = defaultdict()
        numbers.default_factory = numbers.__len__  # a new word gets the next number
        return numbers, set()

    numbers, seen = fresh()
    for batch in batches:
        for doc_id, text, part in zip(*batch.columns):  # one text at a time, not the batch once more
            text, block = text.as_py() or "", part.as_py() << 32 if block is None else block
            if size and (size + len(text) > bounds.text_bytes or len(numbers) >= bounds.words):
                block, size = block + 1, 0
                numbers, seen = fresh()
            size += len(text)
            key = hashlib.sha256(text.encode()).digest()
            if key in seen:
                yield block, doc_id, text, key, None, numbers
            else:
                seen.add(key)
                yield block, doc_id, text, key, list(map(numbers.__getitem__, split(text))), numbers


def block_words(docs: DataFrame, pattern: str, bounds: Blocks) -> DataFrame:
    """One row per block and distinct word: block, number, word."""

    def run(batches):
        def rows(block, numbers):
            items = list(numbers)
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array(range(i, i + len(part)), pa.int32()), pa.array(part, pa.string())], ["block", "number", "word"])

        last = None
        for block, _, _, _, _, numbers in blocks(batches, pattern, bounds):
            if last is not None and last[0] != block:
                yield from rows(*last)
            last = block, numbers
        if last is not None:
            yield from rows(*last)

    return docs.mapInArrow(run, "block long, number int, word string")


def block_texts(docs: DataFrame, pattern: str, bounds: Blocks) -> DataFrame:
    """One row per document: block, doc_id, its words' numbers, a checksum of its text."""
    from pyspark.sql.pandas.types import to_arrow_type

    doc_id = docs.schema["doc_id"]
    id_type = to_arrow_type(doc_id.dataType)
    schema = f"block long, doc_id {doc_id.dataType.simpleString()}, words binary, checksum long"

    def run(batches):
        rows: list[tuple] = []

        def batch():
            types = (pa.int64(), id_type, pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["block", "doc_id", "words", "checksum"])

        at, packed = None, {}
        for block, doc, text, key, numbers, _ in blocks(batches, pattern, bounds):
            if block != at:
                at, packed = block, {}
            if numbers is not None:
                packed[key] = pack(numbers)
            rows.append((block, doc.as_py(), packed[key], zlib.crc32(text.encode())))
            if len(rows) == 500:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    return docs.mapInArrow(run, schema)


# -- encoding -------------------------------------------------------------------


def encode_words(words: DataFrame, path: str, pattern: str) -> DataFrame:
    """ids, blocks, numbers: the ids of each distinct word and where it is mentioned; a word with many blocks has several rows."""

    def run(batches):
        def make():
            import tiktoken

            return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})

        encode = kept_in_worker(f"bpe:{path}:{pattern}", make).encode_ordinary
        last, ids = None, []
        for batch in batches:  # sorted by word
            word = batch.column(2).to_pylist()
            first = [i for i in range(len(word)) if not i or word[i] != word[i - 1] or i % PLACES == 0]
            out = []
            for i in first:
                if word[i] != last:
                    last, ids = word[i], encode(word[i])
                out.append(ids)
            offsets = pa.array([*first, len(word)], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, batch.column(i)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32())), *lists], ["ids", "blocks", "numbers"])

    by_word = words.repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(run, "ids array<int>, blocks array<long>, numbers array<int>")


def decode_words(encoded: DataFrame, tokens: DataFrame) -> DataFrame:
    """block, words, bytes: ids and bytes of many words of a block in one row.

    Ids are exploded with their positions and joined with the token-byte table,
    which is broadcast, so the ids of a word stay one after the other; that is
    checked where they are put together.
    """
    each = encoded.select(F.posexplode("ids").alias("place", "id"), "blocks", "numbers")
    once = [F.when(F.col("place") == 0, F.col(c)).alias(c) for c in ("blocks", "numbers")]
    joined = each.join(F.broadcast(tokens.withColumnRenamed("id", "token")), F.col("id") == F.col("token"))

    def words_of(batches):
        """Whole words of each batch: length and byte length of each, ids, bytes, and block, number and word of each mention."""
        held = None
        for batch in batches:
            batch = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            place = batch.column(0).to_numpy()
            start = np.flatnonzero(place == 0)
            follows = np.diff(place) == 1
            if not len(start) or start[0] or not (follows | (place[1:] == 0)).all():
                raise RuntimeError("the ids of a word came apart")
            yield from _words(batch.slice(0, start[-1]), start[:-1])  # the last word may go on in the next batch
            held = batch.slice(start[-1])
        if held is not None:
            yield from _words(held, np.zeros(1, np.int64))

    def run(batches):
        held, size = [], 0
        for words in words_of(batches):
            held.append(words)
            size += len(words[4])
            if size >= HELD:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)

    return joined.select("place", "id", "bytes", *once).mapInArrow(run, "block long, words binary, bytes binary")


def _words(rows: pa.RecordBatch, start: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    if not len(start):
        return
    ids = rows.column(1).to_numpy()
    length = np.diff(start, append=len(ids))
    each = pa.compute.binary_length(rows.column(2)).to_numpy().astype(np.int64)
    sizes = np.add.reduceat(each, start)
    data = np.frombuffer(b"".join(rows.column(2).to_pylist()), "u1")
    blocks, numbers = (rows.column(i).take(pa.array(start)) for i in (3, 4))
    mentions = pa.compute.list_value_length(blocks).to_numpy()
    yield length, sizes, ids, data, blocks.flatten().to_numpy(), numbers.flatten().to_numpy(), np.repeat(np.arange(len(start)), mentions)


def packed(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Words by block: steps between their numbers, how many ids and bytes each has, and all ids; and all bytes."""
    shift = np.cumsum([0, *(len(h[0]) for h in held)])
    length, size, ids, data, block, number = (np.concatenate([h[i] for h in held]) for i in range(6))
    word = np.concatenate([h[6] + s for h, s in zip(held, shift)])
    first, place = np.cumsum(length) - length, np.cumsum(size) - size
    order = np.lexsort((number, block))
    block, number, word = block[order], number[order], word[order]
    edges = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
    rows: list[tuple] = []
    for lo, hi in zip(edges, [*edges[1:], len(block)]):
        w = word[lo:hi]
        parts = (np.array([hi - lo]), np.diff(number[lo:hi], prepend=0), length[w], size[w], ragged(ids, first[w], length[w]))
        rows.append((int(block[lo]), pack(np.concatenate(parts)), zlib.compress(ragged(data, place[w], size[w]).tobytes(), 1)))
        if len(rows) == 200 or hi == len(block):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["block", "words", "bytes"])
            rows = []


# -- putting together -------------------------------------------------------------


class BlockWords:
    """Ids and bytes of a block's words, laid end to end as they come in."""

    def __init__(self, block: int):
        self.block, self.parts, self.ids = block, [], None

    def add(self, words: bytes, data: bytes) -> None:
        values = unpack(words).astype(np.int64)
        n = values[0]
        self.parts.append((np.cumsum(values[1 : n + 1]), *values[n + 1 : 3 * n + 1].reshape(2, -1), values[3 * n + 1 :].astype(np.int32), np.frombuffer(zlib.decompress(data), "u1")))

    def lay_out(self) -> None:
        none = (*(np.zeros(0, np.int64),) * 3, np.zeros(0, np.int32), np.zeros(0, "u1"))
        numbers, length, size, self.ids, self.data = (np.concatenate(x) for x in zip(none, *self.parts))
        many = numbers.max(initial=-1) + 1
        self.length, self.first, self.size, self.place = (np.zeros(many, np.int64) for _ in range(4))
        self.length[numbers], self.first[numbers] = length, np.cumsum(length) - length
        self.size[numbers], self.place[numbers] = size, np.cumsum(size) - size
        self.parts = []

    def text(self, words: bytes) -> tuple[np.ndarray, bytes]:
        """Ids and bytes of a document, by the positions of its words."""
        if self.ids is None:
            self.lay_out()
        w = unpack(words)
        if not len(w):
            return np.zeros(0, np.int32), b""
        if w.max() >= len(self.length):
            raise RuntimeError(CHANGED)
        return ragged(self.ids, self.first[w], self.length[w]), ragged(self.data, self.place[w], self.size[w]).tobytes()


CHANGED = "docs changed between two readings; write it before encoding"


def put_together(rows: DataFrame, id_type: pa.DataType, schema: str) -> DataFrame:
    """Documents from rows that come sorted by block, its words first."""

    def run(batches):
        held = BlockWords(-1)
        for batch in batches:
            block, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(texts.astype(int)) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(block)]):
                if lo == hi:
                    continue
                if held.block != block[lo]:
                    held = BlockWords(block[lo])
                part = batch.slice(lo, hi - lo)
                if not texts[lo]:
                    for words, data in zip(part.column(2), part.column(3)):
                        held.add(words.as_py(), data.as_py())
                    continue
                for k in range(0, hi - lo, 200):  # bounds a batch that leaves
                    some = part.slice(k, 200)
                    out = [held.text(p.as_py()) for p in some.column(2)]
                    if any(zlib.crc32(b) != c for (_, b), c in zip(out, some.column(5).to_pylist())):
                        raise RuntimeError(CHANGED)
                    ids, lengths = np.concatenate([i for i, _ in out]), np.cumsum([0, *(len(i) for i, _ in out)])
                    yield pa.RecordBatch.from_arrays(
                        [some.column(4).cast(id_type), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(ids, pa.int32())), pa.array([b for _, b in out], pa.binary())],
                        ["doc_id", "ids", "decoded"],
                    )

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, bounds: Blocks = Blocks()) -> DataFrame:
    """doc_id, ids (array of int), decoded (the bytes those ids stand for) of every document."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = only(docs, doc_id="doc_id", text="text").withColumn("part", F.spark_partition_id().cast("long"))
    kind = docs.schema["doc_id"].dataType
    words = decode_words(encode_words(block_words(docs, pattern, bounds), path, pattern), token_bytes(docs.sparkSession, path))
    texts = block_texts(docs, pattern, bounds)
    by_block = words.unionByName(texts, allowMissingColumns=True).repartition("block")
    rows = by_block.select("block", F.col("bytes").isNull().alias("text"), "words", "bytes", "doc_id", "checksum").sortWithinPartitions("block", "text")
    return put_together(rows, to_arrow_type(kind), f"doc_id {kind.simpleString()}, ids array<int>, decoded binary")


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids: exploded with positions, joined with the token-byte table, put together by position.

    Null ids decode to null, no ids to nothing, a list that holds an unknown or null id to null.
    """
    tokens = F.broadcast(token_bytes(rows.sparkSession, path).withColumnRenamed("id", "token"))
    held = rows.select(F.struct(*rows.columns).alias("row"), F.monotonically_increasing_id().alias("at"), F.col(f"`{ids}`").alias("ids"))
    each = held.select("row", "at", F.posexplode_outer("ids").alias("place", "id")).join(tokens, F.col("id") == F.col("token"), "left")
    # The whole row rides with its first token only.
    each = each.select("at", "place", F.when(F.coalesce("place", F.lit(0)) == 0, F.col("row")).alias("row"), F.hex("bytes").alias("hex"))
    known = F.size(F.col(f"row.`{ids}`"))
    joined = each.groupBy("at").agg(F.max_by("row", F.when(F.col("row").isNotNull(), F.lit(1))).alias("row"), F.array_sort(F.collect_list(F.when(F.col("hex").isNotNull(), F.struct("place", "hex")))).alias("parts"))
    whole = (F.size("parts") == known) & F.col(f"row.`{ids}`").isNotNull()
    value = F.when(whole, F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), "")))
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in rows.columns if c != to], value.alias(to))
