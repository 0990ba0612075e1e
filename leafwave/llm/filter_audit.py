"""What every order of a set of filters removes, from count-weighted decision diagrams.

Each document becomes a mask of the filters it fails, and masks are counted per
part. A part's counts make a decision diagram: one level per filter, a pass and
a fail branch, and at the ends how many documents (and how many labelled good
or toxic) have that mask; equal branches are shared and empty ones dropped. The
weight of a node is that of everything below it, so applying the filters in the
order of the levels is one walk along the pass branches: at each level the fail
branch is what the filter removes and the pass branch what is left. Swapping
two neighbouring levels rearranges only the branches between them, and n! - 1
such swaps visit every order, so a part's documents are counted once and never
again.

The duplicate filter needs the whole table: a document fails it if a smaller
doc_id has the same text. Rows are first counted per (text, part, doc_id), then
per (text, part) together with the row of the smallest id there, and the
smallest of all parts decides. Both counts combine before the shuffle, so one
text that fills a third of the table is no hot key; texts travel as SHA-256.

Null texts count as empty, null parts as the empty string. A row with a null
doc_id has no smaller id and makes none for others; it fails no duplicate test
and has no labels. Repeated rows count each, and rows that share the smallest
id of a text all pass. A doc_id with several labels has each that any of them
gives. Very long texts are read whole; other columns are never looked at. An
empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from leafwave.llm.common import once, only, words

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
MARKS = "[#$%&*|]"
DUPLICATE = 1 << FILTERS.index("E")
WEIGHTS = ("n", "good", "toxic")


# -- masks ----------------------------------------------------------------------


def text_failures(text: Column, parts: Column) -> Column:
    """Bits of the filters A to D that a text fails; ``parts`` are its words."""
    n = F.size(parts)
    fails = (
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(parts)) < MIN_DISTINCT_PERCENT * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike(MARKS),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of failed filters, and how many documents, good and toxic ones have it there."""
    docs = only(docs, doc_id="doc_id", text="text", source="source")
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), once(words(text)).alias("words"))
    rows = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_failures(F.col("text"), F.col("words")).alias("mask"))
    # Rows without an id are spread by their text instead.
    rows = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("digest", "part")).alias("id"), F.col("doc_id").isNotNull().alias("known"), "part", "digest", "mask")
    rows = rows.groupBy("id", "known", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = only(labels, id="doc_id", quality="quality", toxic="toxic").where("id IS NOT NULL").groupBy(F.col("id").cast("long").alias("id"))
    marks = marks.agg(*[F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).cast("long").alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    rows = rows.join(marks.withColumn("known", F.lit(True)), ["id", "known"], "left")
    rows = rows.select("id", "known", "part", "digest", "mask", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in WEIGHTS[1:]])

    first = F.min(F.when(F.col("known"), F.struct("id", *WEIGHTS))).alias("first")
    loose = F.sum(F.when(~F.col("known"), F.col("n")).otherwise(0)).alias("loose")
    texts = rows.groupBy("digest", "part").agg(F.max("mask").alias("mask"), *[F.sum(c).alias(c) for c in WEIGHTS], first, loose)
    earliest = F.min("first.id").over(Window.partitionBy("digest"))
    passing = {c: F.when(F.col("first.id") == F.col("earliest"), F.col(f"first.{c}")).otherwise(0) for c in WEIGHTS}
    passing["n"] = passing["n"] + F.col("loose")
    either = F.array(
        F.struct("mask", *[passing[c].alias(c) for c in WEIGHTS]),
        F.struct((F.col("mask") + DUPLICATE).alias("mask"), *[(F.col(c) - passing[c]).alias(c) for c in WEIGHTS]),
    )
    split = texts.withColumn("earliest", earliest).select("part", F.inline(either))
    return split.where("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in WEIGHTS])


# -- diagrams ---------------------------------------------------------------------


class Node:
    """A branch of a diagram: what passes and what fails the filter of its level, and the weight of both."""

    __slots__ = ("passing", "failing", "total")

    def __init__(self, passing: Node | None, failing: Node | None, total: tuple[int, ...]):
        self.passing, self.failing, self.total = passing, failing, total


class Diagram:
    """Weights by mask, with one level per filter in the order of ``levels``."""

    def __init__(self, n: int, weights: dict[int, tuple[int, ...]]):
        self.levels = list(range(n))
        self.width = len(next(iter(weights.values()), ()))
        self.empty = Node(None, None, (0,) * self.width)
        self.shared: dict = {}
        self.root = self._build(weights, 0)

    def node(self, passing: Node, failing: Node) -> Node:
        if passing is self.empty and failing is self.empty:
            return self.empty
        total = tuple(a + b for a, b in zip(passing.total, failing.total))
        return self.shared.setdefault((passing, failing), Node(passing, failing, total))

    def _build(self, weights: dict[int, tuple[int, ...]], level: int) -> Node:
        if not weights:
            return self.empty
        if level == len(self.levels):
            (weight,) = weights.values()
            return self.shared.setdefault(weight, Node(None, None, weight)) if any(weight) else self.empty
        bit = 1 << self.levels[level]
        sides = ({m: w for m, w in weights.items() if bool(m & bit) is fails} for fails in (False, True))
        return self.node(*(self._build(s, level + 1) for s in sides))

    def branches(self, node: Node) -> tuple[Node, Node]:
        return (node, node) if node is self.empty else (node.passing, node.failing)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one."""
        done: dict[Node, Node] = {}

        def below(node: Node, depth: int) -> Node:
            if node is self.empty:
                return node
            if node not in done:
                if depth == level:
                    (pp, pf), (fp, ff) = map(self.branches, (node.passing, node.failing))
                    done[node] = self.node(self.node(pp, fp), self.node(pf, ff))
                else:
                    done[node] = self.node(below(node.passing, depth + 1), below(node.failing, depth + 1))
            return done[node]

        self.root = below(self.root, 0)
        self.levels[level : level + 2] = self.levels[level + 1], self.levels[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the all-pass path: filter, weight left after it, weight it removes."""
        node = self.root
        for f in self.levels:
            node, gone = self.branches(node)
            yield f, node.total, gone.total


def level_swaps(n: int) -> Iterator[int]:
    """Neighbours to exchange, one after the other, to meet all n! orders: the last one moves to and fro through the orders of the rest."""
    if n < 2:
        return
    inner, down = level_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + down
        down = not down


def audit_part(weights: dict[int, tuple[int, int, int]], filters: str = FILTERS) -> pd.DataFrame:
    """All orders of ``filters`` over one part's (documents, good, toxic) by mask."""
    diagram = Diagram(len(filters), weights)
    orders = [(list(diagram.levels), list(diagram.steps()))]
    for level in level_swaps(len(filters)):
        diagram.swap(level)
        orders.append((list(diagram.levels), list(diagram.steps())))
    fails, alone, shares = {}, {}, dict.fromkeys(range(len(filters)), 0)
    for _, steps in orders:
        fails[steps[0][0]] = steps[0][2][0]  # as the first filter it removes all that fail it
        alone[steps[-1][0]] = steps[-1][2][0]  # as the last one only what fails no other
        for f, _, gone in steps:
            shares[f] += gone[0]
    rows = [
        ("".join(filters[f] for f in levels), k + 1, left[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], shares[f])
        for levels, steps in orders
        for k, (f, left, gone) in enumerate(steps)
    ]
    return pd.DataFrame(rows, columns=["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])


SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Steps of all orders for each part; a part has at most 32 counts, whatever its size."""

    def run(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        weights = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in counts.itertuples()}
        out = audit_part(weights)
        out.insert(0, "part", key[0])
        return out

    return mask_counts(docs, labels).groupBy("part").applyInPandas(run, SCHEMA)
