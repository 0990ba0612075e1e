"""Near duplicates by DartMinHash signatures, banded joining and exact checks.

A text's elements are its word five-grams, each with its number of occurrences
as weight. Darts are thrown at random, but by hash alike in every text, into
the region (element) x (weight) x (rank): each unit of weight of an element
gets darts at ranks of a Poisson process, each dart has a coordinate, and a
text keeps, per coordinate, the dart of lowest rank inside its own region. Two
texts keep the same dart at a coordinate with the probability of their weighted
Jaccard similarity. Only darts below a rank that fills all coordinates are
made, so a signature costs time in proportion to the elements and coordinates.

Bands of ``rows`` coordinates are hashed to buckets; texts of 0.8 similarity
share none of the 32 bands with a probability below 1e-4. Texts in a common
bucket are compared by stars, never by all pairs: each round picks centres in
every bucket and compares them, exactly, with the bucket's texts of other
classes. The first centre is the text that meets most others, the natural
original of a group of copies. Found links merge classes, and buckets that hold
one class are done. A bucket of up to ``SMALL`` texts is worked through until
each pair in it has been compared or lies in one class. A larger one has
``ALONE`` rounds of one centre. If it is still mixed then, of texts that share
much but are mostly no duplicates, it goes another way, without loss: each of its
texts is put under its rarest elements, as many as two texts of the wanted
similarity cannot avoid having one of in common, and those groups are worked
through to the end. Passages that many texts share are not rare, so texts that
only share those do not meet there. Texts are not compared where their numbers
of elements, or of those from the common one on, rule the similarity out.

Exact copies count as one text throughout, so a group of thousands costs one
signature row per copy and nothing after. All grouping is by text, bucket or
pair; joins on them have plain shuffled sides, whose hot keys Spark splits.
Classes are merged by contracting the links, a few rounds of joins. Every step
is written to the shared folder, so lost executors cost only their tasks.

The class id is the lowest doc_id of its documents. Null text is like no other
text, and its class is the document's own id. Texts without words, the empty
one too, are alike only if equal; a text of fewer than five words is one
element. Repeated rows fall in one class. An empty table gives an empty table,
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.columns import packed
from leafwave.llm.common import kept_in_worker, only, saved
from leafwave.llm.url_filter import bloom_blocks, possible

#: Words per element.
SHINGLE = 5
SIMILARITY = 0.8


@dataclass(frozen=True)
class Bands:
    bands: int = 32
    rows: int = 6

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


#: Texts in a bucket that is worked through as it is.
SMALL = 8
#: Rounds of one centre a bucket, before larger buckets go by their rarest elements.
ALONE = 2
#: Words a worker remembers before it starts over.
REMEMBERED = 300_000
#: Texts whose darts are thrown together.
TOGETHER = 128

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def elements(text: str, hashes: WordHashes) -> np.ndarray:
    """One 64-bit value per unit of weight: the five-gram and which of its occurrences it is."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(h))):
        s = mixed(s + h[i : i + n] + np.uint64(i + 1))
    s.sort()
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return mixed(s + (np.arange(n) - first).astype(np.uint64) * _M2)


def dart_signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """Per set (none empty), the earliest dart of each of ``k`` coordinates."""
    sizes = np.array([len(s) for s in sets])
    unit = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    limit = (k * np.log(k) + 2 * k) / sizes
    best = np.full(len(sets) * k, np.inf)
    kept = np.zeros(len(sets) * k, np.uint64)
    throw = np.zeros(len(unit), np.uint64)

    def next_rank(u: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dart = mixed(u ^ mixed(t + np.uint64(0x9E3779B97F4A7C15)))
        gap = -np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53)
        return gap, dart

    rank, dart = next_rank(unit, throw)
    while True:
        at = np.flatnonzero(rank < limit[owner])
        while len(at):
            r, d = rank[at], dart[at]
            slot = owner[at] * k + (mixed(d + _M1) % np.uint64(k)).astype(np.int64)
            order = np.argsort(-r, kind="stable")  # the last one written is the earliest
            slot, r, d = slot[order], r[order], d[order]
            earlier = r < best[slot]
            slot, r, d = slot[earlier], r[earlier], d[earlier]
            best[slot], kept[slot] = r, d
            throw[at] += np.uint64(1)
            gap, dart[at] = next_rank(unit[at], throw[at])
            rank[at] += gap
            at = at[rank[at] < limit[owner[at]]]
        open_sets = np.unique(np.flatnonzero(np.isinf(best)) // k)
        if not len(open_sets):
            return kept.reshape(len(sets), k)
        limit[open_sets] *= 2


def buckets(signatures: np.ndarray, how: Bands) -> np.ndarray:
    """One 63-bit bucket per band, the sign bit set."""
    parts = signatures.reshape(len(signatures), how.bands, how.rows)
    h = np.broadcast_to(np.arange(how.bands, dtype=np.uint64) * _M1, parts.shape[:2]).copy()
    for i in range(how.rows):
        h = mixed(h ^ parts[:, :, i])
    return h | np.uint64(1 << 63)


def signed_texts(docs: DataFrame, how: Bands) -> DataFrame:
    """(doc_id, node, buckets, cells, n_cells) of every document with text; ``node`` is the text's 128-bit hash."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = kept_in_worker("word hashes", WordHashes)
        for batch in batches:
            for start in range(0, len(batch), TOGETHER):
                part = batch.iloc[start : start + TOGETHER]
                sets = [elements(t, hashes) for t in part["text"]]
                worded = [i for i, s in enumerate(sets) if len(s)]
                rows: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sets)
                if worded:
                    found = buckets(dart_signatures([sets[i] for i in worded], how.coordinates), how).view(np.int64)
                    for i, b in zip(worded, found):
                        rows[i] = b
                cells = [np.unique(s.astype(np.uint32).view(np.int32)) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64"),
                        "node": part["node"],
                        "buckets": rows,
                        "cells": cells,
                        "n_cells": [len(c) for c in cells],
                    }
                )

    texts = only(docs, doc_id="doc_id", text="text").where("text is not null")
    texts = texts.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")
    return texts.mapInPandas(sign, "doc_id long, node binary, buckets array<long>, cells array<int>, n_cells int")


def merge_classes(names: DataFrame, links: DataFrame) -> DataFrame:
    """``names`` (node, label) after joining the classes that ``links`` (a, b), pairs of labels, connect.

    Each round, every end of a link takes the first of itself and its
    neighbours in hash order, links follow to the new labels, and those within
    one label go. Rounds grow with the logarithm of a class's length.
    """
    links = saved(links.distinct())
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy(F.col("a").alias("old")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("old").alias("h"), F.col("old").alias("n"))
        step = saved(first.select("old", F.least(own, F.col("m"))["n"].alias("new")))
        moved = step.where("old <> new")
        names = names.join(moved, names["label"] == moved["old"], "left").select("node", F.coalesce("new", "label").alias("label"))
        ends = links.join(step.select(F.col("old").alias("a"), F.col("new").alias("na")), "a")
        ends = ends.join(step.select(F.col("old").alias("b"), F.col("new").alias("nb")), "b").where("na <> nb")
        links = saved(ends.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct())
    return saved(names)


def similar(pairs: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) of texts whose exact weighted Jaccard similarity is at least ``least``."""
    # Elements are wide: few but those of the texts in a pair go into a shuffle. The joins are what decides.
    asked = bloom_blocks(pairs.select(F.explode(F.array("a", "b")).alias("key")))
    near = possible(cells.select(F.col("node").alias("key"), "cells"), asked)
    left = near.select(F.col("key").alias("a"), F.col("cells").alias("ca"))
    right = near.select(F.col("key").alias("b"), F.col("cells").alias("cb"))
    both = pairs.join(left, "a").join(right, "b")
    # common / (all - common) >= least, with common named once: it is dear
    enough = F.size(F.array_intersect("ca", "cb")) * F.lit(1 + least) >= F.lit(least) * (F.size("ca") + F.size("cb")) - F.lit(1e-9)
    return both.where(enough).select(*pairs.columns)


def bucket_links(left: DataFrame, nodes: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """(node, label): classes of the texts in ``left`` (bucket, node, popular, n_cells)."""
    names = nodes.select("node", F.col("node").alias("label"))
    left = left.withColumn("reach", F.col("n_cells"))
    for _ in range(ALONE):
        left, names = compared(open_buckets(left, names, least), names, cells, least, 1)
    open_texts = open_buckets(left, names, least)
    rare = rarest_elements(saved(open_texts.where(F.col("n") > SMALL).select("node", "popular", "n_cells").distinct()), cells, least)
    left, centres = open_texts.where(F.col("n") <= SMALL).select(*left.columns).unionByName(rare), 4
    while True:
        open_texts = open_buckets(left, names, least)
        if open_texts.isEmpty():
            return names
        left, names = compared(open_texts, names, cells, least, centres)
        centres *= 4


def rarest_elements(texts: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """(bucket, node, popular, n_cells, reach): each of ``texts`` under the rarest of its elements, where another has it too.

    In one order of all elements, two texts of at least ``least`` similarity
    have ``least * size`` in common, so they share one among the first
    ``size - least * size + 1`` of each. ``reach`` counts the text's elements
    from this one on: no more can be in common with a text that shares none before.
    """
    each = saved(cells.join(texts.select("node"), "node").select("node", F.explode("cells").alias("cell")))
    common = each.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = each.join(common, "cell").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "cell"))).alias("own")).join(texts, "node")
    # Elements no other text has come first; the shared ones begin after them.
    shared = shared.withColumn("alone", F.col("n_cells") - F.size("own"))
    first = F.col("n_cells") - F.ceil(F.col("n_cells") * F.lit(least) - F.lit(1e-9)) + 1 - F.col("alone")
    shared = shared.withColumn("own", F.slice("own", F.lit(1), F.greatest(first, F.lit(0)).cast("int")))
    placed = shared.select("node", "popular", "n_cells", "alone", F.posexplode("own.cell").alias("at", "cell"))
    # Not negative, as the buckets of the bands are.
    bucket = F.col("cell").cast("long") + F.lit(2**31)
    return saved(placed.select(bucket.alias("bucket"), "node", "popular", "n_cells", (F.col("n_cells") - F.col("alone") - F.col("at")).alias("reach")))


def leads(least: float) -> Column:
    """Whether a text can be the smaller one of a pair: it needs a ``reach`` of as many elements as equal sizes call for."""
    return F.col("reach") * F.lit(1 + least) >= F.lit(2 * least) * F.col("n_cells") - F.lit(1e-9)


def open_buckets(left: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """``left`` with labels and the bucket's number ``n`` of texts, where it holds several classes and a text that leads."""
    tagged = saved(left.join(names, "node"))
    mixed_ones = tagged.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").cast("int").alias("n"), F.max(leads(least)).alias("led"))
    return saved(tagged.join(mixed_ones.where("lo <> hi and led").select("bucket", "n"), "bucket"))


def compared(texts: DataFrame, names: DataFrame, cells: DataFrame, least: float, centres: int) -> tuple[DataFrame, DataFrame]:
    """What is left of the open buckets' ``texts``, and the classes, after a round of stars.

    Every bucket has up to ``centres`` of them, in small buckets up to four at
    least. A centre has been compared with all its bucket and leaves it.
    """
    group = F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("n") > SMALL, F.lit(centres)).otherwise(F.lit(max(4, centres))))
    best = F.max(F.struct("popular", "node", "label", "n_cells", "reach")).alias("c")
    stars = texts.where(leads(least)).groupBy("bucket", group.alias("group")).agg(best)
    stars = saved(stars.select("bucket", F.col("c.node").alias("centre"), F.col("c.label").alias("at"), F.col("c.n_cells").alias("size"), F.col("c.reach").alias("far")))
    # common / (all - common) >= least, with as many in common as there can be
    fits = F.least("reach", "far") * F.lit(1 + least) >= F.lit(least) * (F.col("n_cells") + F.col("size")) - F.lit(1e-9)
    met = texts.join(stars, "bucket").where("node <> centre and label <> at").where(fits)
    ends = F.when(F.col("node") < F.col("centre"), F.struct(F.col("node").alias("a"), F.col("centre").alias("b"), F.col("label").alias("la"), F.col("at").alias("lb")))
    ends = ends.otherwise(F.struct(F.col("centre").alias("a"), F.col("node").alias("b"), F.col("at").alias("la"), F.col("label").alias("lb")))
    pairs = saved(met.select(ends.alias("p")).select("p.*").distinct())
    found = saved(similar(pairs, cells, least).select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")))
    if not found.isEmpty():
        names = merge_classes(names, found)
    left = texts.join(stars.select("bucket", F.col("centre").alias("node")), ["bucket", "node"], "left_anti")
    return left.select("bucket", "node", "popular", "n_cells", "reach"), names


def duplicate_classes(docs: DataFrame, how: Bands = Bands(), least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, node) of every document with text, and (node, label, class_id, first_id) of every text.

    ``class_id`` is the lowest doc_id of the class, ``first_id`` that of the text.
    """
    signed = saved(signed_texts(docs, how))
    members = signed.select("doc_id", "node")
    texts = saved(signed.groupBy("node").agg(F.first("buckets").alias("buckets"), F.first("n_cells").alias("n_cells"), F.min("doc_id").alias("first_id")))
    asked = texts.select("node", "n_cells", F.explode("buckets").alias("bucket"))
    shared = saved(asked.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    # Most buckets hold one text. Those rows stay out of the shuffle; again the join is what decides.
    several = possible(asked.withColumnRenamed("bucket", "key"), bloom_blocks(shared.select(F.col("bucket").alias("key"))))
    left = saved(several.withColumnRenamed("key", "bucket").join(shared, "bucket"))
    nodes = saved(left.groupBy("node").agg(F.sum("size").alias("popular"), F.first("n_cells").alias("n_cells")))
    left = left.select("bucket", "node").join(nodes, "node")
    # The filter spares the shuffle most texts that meet no other; the join is what decides.
    near = possible(signed.select(F.col("node").alias("key"), "cells"), bloom_blocks(nodes.select(F.col("node").alias("key"))))
    near = near.select(F.col("key").alias("node"), "cells").join(nodes.select("node"), "node")
    cells = saved(near.groupBy("node").agg(F.first("cells").alias("cells")))
    names = bucket_links(left, nodes, cells, least)
    named = saved(texts.select("node", "first_id").join(names, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "first_id"))
    lowest = saved(named.groupBy("label").agg(F.min("first_id").alias("class_id")))
    return members, saved(named.join(lowest, "label").select("node", "label", "class_id", "first_id"))


def classes(docs: DataFrame, how: Bands = Bands(), least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every document."""
    members, texts = duplicate_classes(docs, how, least)
    found = members.join(texts, "node").select("doc_id", "class_id")
    alone = docs.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return found.unionByName(alone)


def keep_first(docs: DataFrame, how: Bands = Bands(), least: float = SIMILARITY) -> DataFrame:
    """One row of each class, columns unchanged: the document whose id names the class.

    Documents with null text all stay.
    """
    docs, back = packed(docs, ("doc_id", "text"))
    _, texts = duplicate_classes(docs, how, least)
    first = texts.where("first_id <=> class_id").groupBy("label").agg(F.min(F.struct("node", "first_id")).alias("f"))
    first = saved(first.select(F.col("f.node").alias("__nd_node"), F.col("f.first_id").alias("__nd_id")))
    named = docs.where("text is not null").withColumn("__nd_text", F.unhex(F.md5("text")))
    kept = named.join(first, (F.col("__nd_text") == F.col("__nd_node")) & F.col("doc_id").eqNullSafe(F.col("__nd_id")))
    # Only repeated rows are left to tell apart; they are already together.
    kept = kept.dropDuplicates(["__nd_node", "__nd_id"]).select(*back())
    return kept.unionByName(docs.where("text is null").select(*back()))
