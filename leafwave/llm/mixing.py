"""Mixing sources to target weights.

Words are aggregated per source, targets are set by weight, and a source's
repetition rate is target / size. Every document is emitted floor(rate) times,
plus one more copy when a hash-seeded Bernoulli draw, with the rate's fraction
as probability, says so.

Targets: together they hold ``budget`` times all words, shared by weight. No
target exceeds ``max_repeats`` times its source's size; what is cut goes to the
others by weight until none is above. That is one water level L: a target is
min(max_repeats * size, L * weight). Sources fill up in the order of size /
weight, so running sums over that order give L.

The draw of a document depends on its id, its text and the seed alone, so reruns, lost executors and other partitionings give the same mix.

The statistics hold one row per source; they are written out, so Spark
broadcasts them when they are small and otherwise joins by shuffle with skew
splitting. Documents themselves are never grouped: a source with a third of
all rows costs no more than any other. The running sums order the sources, one
row each, in one task.

A null source is a source of its own, last in order. A null or empty text has
size 0 and is emitted by its source's rate like any other. Repeated rows draw
alike. A source without words has target 0 and rate 0. An empty table gives an
empty table. Very long texts are counted whole. Extra columns are carried along
whatever their names; only ``mix`` leaves out a column of that name, in whose
place the result stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leafwave.llm.columns import packed
from leafwave.llm.common import once, saved, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
USED = ("doc_id", "text", "source")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, budget: int = 1) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size).

    Weights repeat over the sources in code point order, null last.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long"))
    full = F.col("source_size") * max_repeats
    everyone = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        (F.sum("source_size").over(everyone) * budget - F.coalesce(F.sum(full).over(before), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    capped = full * F.col("weight_left") <= F.col("weight") * F.col("words_left")
    # The first source in fill order that is not capped has the most weight left and fixes the level.
    first = F.max(F.when(~capped, F.struct("weight_left", "words_left"))).over(everyone)
    per = per.select("source", "source_size", "weight", capped.alias("capped"), first.alias("at"))
    target = F.when(F.col("capped"), F.col("source_size").cast("double") * max_repeats).otherwise(
        F.col("weight").cast("double") * (F.col("at.words_left").cast("double") / F.col("at.weight_left").cast("double"))
    )
    per = per.select("source", "source_size", target.alias("target"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    return per.withColumn("rate", rate)


def copies(rate: Column, identity: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with the fraction's probability by the hash of ``identity``."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity)), 1, 12)
    draw = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))
    whole = F.floor(rate)
    return whole + F.when(draw < rate - whole, F.lit(1)).otherwise(F.lit(0))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with the struct ``mix``: size, source_size, target, rate, copies."""
    docs, back = packed(docs, USED)
    size = word_count(F.col("text"))
    stats = saved(source_targets(docs.select("source", size.alias("size")), weights, max_repeats))
    stats = stats.select(F.col("source").alias("__mix_source"), F.struct("source_size", "target", "rate").alias("__mix_stats"))
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    joined = docs.join(stats, F.col("source").eqNullSafe(F.col("__mix_source")), "left")
    s = F.col("__mix_stats")
    verdict = F.struct(
        size.alias("size"), s["source_size"].alias("source_size"), s["target"].alias("target"),
        s["rate"].alias("rate"), copies(s["rate"], identity, seed).cast("int").alias("copies"),
    )
    mixed = joined.select(*docs.columns, once(verdict).alias("__mix_verdict"))
    return mixed.select(*back("mix"), F.col("__mix_verdict").alias("mix"))


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns unchanged."""
    docs, back = packed(docs, USED)
    out = mix(docs, weights, max_repeats, seed).where("mix.copies > 0")
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies"))).alias("__mix_copy")
    return out.select(*docs.columns, repeated).select(*back())
