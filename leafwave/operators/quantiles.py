"""Exact grouped quantiles that hold when one group has most of the rows.

``percentile`` keeps every distinct value of a group in one reducer. That is
fine for ordinary groups, and the map side already combines them. A group
past ``hot_rows`` is split instead: equal values are counted, an approximate
sketch of the different ones proposes cut points, exact counts per (group, slice)
locate the slice that holds each wanted rank, and only that slice is sorted. The
sketch only balances the slices; ranks are counted exactly, so the answer does
not depend on its error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

HOT_ROWS = 5_000_000
ARRAY_ROWS = 200_000
MAX_HOT_KEYS = 50_000
SLICES = 1024


def _slice_index(value: Column, cuts: Column, slices: int) -> Column:
    """Number of cut points below ``value``, by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(slices.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(cuts, n + s - 1) < value, n + s).otherwise(n))


def _hot_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: Sequence[float], slices: int
) -> DataFrame:
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    fractions = [i / slices for i in range(1, slices)]
    cuts = counted.groupBy(*keys).agg(
        F.percentile_approx(value, fractions, 10 * slices).alias("__cuts"),
        F.sum("__c").alias("__n"),
    )
    # The whole table is one key, whose rows no shuffle by key would spread.
    near = F.broadcast(cuts) if keys == ["__all"] else cuts
    tagged = counted.join(near.drop("__n"), keys).withColumn("__slice", _slice_index(F.col(value), F.col("__cuts"), slices))
    tagged = tagged.select(*keys, value, "__c", "__slice")

    ordered = Window.partitionBy(*keys).orderBy("__slice")
    sizes = (
        tagged.groupBy(*keys, "__slice")
        .agg(F.sum("__c").alias("count"))
        .withColumn("__before", F.sum("count").over(ordered) - F.col("count"))
    )
    position = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(
        F.array(*[f(p).cast("bigint") for p in position for f in (F.floor, F.ceil)])
    )
    wanted = sizes.join(cuts.select(*keys, "__n"), keys).withColumn(
        "__ranks",
        F.filter(
            ranks,
            lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("count")),
        ),
    )
    wanted = wanted.where(F.size("__ranks") > 0).select(*keys, "__slice", "__before", "__ranks")

    inside = Window.partitionBy(*keys, "__slice").orderBy(value)
    picked = (
        tagged.join(F.broadcast(wanted), [*keys, "__slice"])
        .withColumn("__hi", F.col("__before") + F.sum("__c").over(inside))
        .withColumn(
            "__ranks",
            F.filter(
                "__ranks",
                lambda r: (r >= F.col("__hi") - F.col("__c")) & (r < F.col("__hi")),
            ),
        )
        .select(*keys, value, F.explode("__ranks").alias("__rank"))
    )
    # At most two rows per probability and group reach this aggregate.
    by_rank = picked.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("__rank", value))).alias("__at")
    )
    interpolated = []
    for p in position:
        low = F.element_at("__at", F.floor(p).cast("bigint"))
        high = F.element_at("__at", F.ceil(p).cast("bigint"))
        interpolated.append(low + (high - low) * (p - F.floor(p)))
    return by_rank.join(cuts.select(*keys, "__n"), keys).select(
        *keys, F.array(*interpolated).alias("q"), "__n"
    )


def _hot_groups(rows: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys of the groups above ``hot_rows``, or None; one counting pass runs here.

    Up to ``MAX_HOT_KEYS`` keys become a local, broadcast table; there cannot
    be more than (all rows / hot_rows) of them. Beyond that the join is an
    ordinary one, where adaptive execution splits skewed partitions.
    """
    hot = rows.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys)
    found = hot.limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return None
    if len(found) > MAX_HOT_KEYS:
        return hot
    return F.broadcast(rows.sparkSession.createDataFrame(found, hot.schema))


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    out: str = "q",
    hot_rows: int = HOT_ROWS,
    slices: int = SLICES,
    count: str | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group.

    Returns ``keys`` plus ``out``, an array aligned with ``probs``, and with
    ``count`` a column of that name holding the group's size. NULLs are
    ignored. One counting pass runs when the plan is built, to see which groups
    need splitting; without any, the plan is a plain aggregate.
    """
    keys = list(keys)
    whole = not keys
    rows = df.where(F.col(value).isNotNull())
    if whole:
        rows, keys = rows.select(F.lit(0).alias("__all"), value), ["__all"]
    else:
        rows = rows.select(*keys, value)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())

    hot = _hot_groups(rows, keys, hot_rows)
    plain = lambda part: part.groupBy(*keys).agg(
        F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("q"),
        F.count(F.lit(1)).alias("__n"),
    )
    if hot is None:
        result = plain(rows)
    elif whole:
        result = _hot_quantiles(rows, keys, value, probs, slices)
    else:
        result = plain(rows.join(hot, keys, "left_anti")).unionByName(
            _hot_quantiles(rows.join(hot, keys), keys, value, probs, slices)
        )
    size = [F.col("__n").alias(count)] if count else []
    return result.select(*([] if whole else keys), F.col("q").alias(out), *size)


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str, **kw) -> DataFrame:
    """Exact median per group."""
    q = group_quantiles(df, keys, value, [0.5], out="__q", **kw)
    return q.select(*keys, F.col("__q")[0].alias(out))


def group_medians(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Exact median of several columns per group; every group is kept, all-NULL columns give NULL.

    Ordinary groups need one aggregate for all columns.
    """
    keys = list(keys)
    rows = df.select(*keys, *columns)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    hot = _hot_groups(rows, keys, hot_rows)
    small = rows if hot is None else rows.join(hot, keys, "left_anti")
    out = small.groupBy(*keys).agg(*[F.percentile(c, 0.5).alias(c) for c in columns])
    if hot is None:
        return out
    large = rows.join(hot, keys)
    part = large.select(*keys).distinct()
    for c in columns:
        one = _hot_quantiles(large.where(F.col(c).isNotNull()).select(*keys, c), keys, c, [0.5], SLICES)
        part = part.join(one.select(*keys, F.col("q")[0].alias(c)), keys, "left")
    return out.unionByName(part)


def _middle(ordered: Column) -> Column:
    """Median of a sorted array."""
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return (low + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def median_and_mad(
    df: DataFrame, keys: Sequence[str], value: str, hot_rows: int = ARRAY_ROWS
) -> DataFrame:
    """Per group: ``median``, unscaled ``mad`` and row count ``n_obs``.

    Groups of at most ``hot_rows`` values go through one sorted array each, so
    the input is read once for both medians; larger ones are sliced twice.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias(value))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    hot = _hot_groups(rows, keys, hot_rows)
    small = rows if hot is None else rows.join(hot, keys, "left_anti")
    lists = small.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias("__v"))
    lists = lists.withColumn("median", _middle(F.col("__v")))
    deviations = F.array_sort(F.transform("__v", lambda x: F.abs(x - F.col("median"))))
    out = lists.select(
        *keys, "median", _middle(deviations).alias("mad"), F.size("__v").cast("bigint").alias("n_obs")
    )
    if hot is None:
        return out
    large = rows.join(hot, keys)
    med = _hot_quantiles(large, keys, value, [0.5], SLICES).select(*keys, F.col("q")[0].alias("median"))
    dev = large.join(med, keys).select(*keys, F.abs(F.col(value) - F.col("median")).alias("__dev"))
    mad = _hot_quantiles(dev, keys, "__dev", [0.5], SLICES).select(*keys, F.col("q")[0].alias("mad"))
    n = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_obs"))
    return out.unionByName(med.join(mad, keys).join(n, keys))
