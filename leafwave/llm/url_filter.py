"""URL verdicts: rules and listed URLs, found by a blocked Bloom filter and an exact join.

The list holds rules (a host and a path; it fits the host and its subdomains
where the path starts with the rule's) and canonical URLs. Every URL is turned
into the keys that could be listed: its own canonical form, and each suffix of
its host with each prefix of its path that has the length of some rule's path.
A blocked Bloom filter of the listed keys lets few keys through; an exact hash
join with the list removes the false positives. The longest rule that fits
gives the verdict; where none fits, a listed canonical URL is blocked and any
other allowed.

The filter is a table of at most ``BLOCKS`` rows, each a block of 512 bits in
eight longs; a key sets one bit in each long of one block. Its size is bounded
by the number of blocks, whatever the list's size, so it may be broadcast: a
longer list only lets more false positives through to the exact join.

Keys of rules can be hot (a rule for a top-level domain fits most pages), so
they are salted, with the rules copied to each salt. Pages join nothing but
the filter; only hits are shuffled, and all rows of one (page, URL) meet again
in one aggregate.

A null URL, or one without ``://``, has empty host and path, fits no rule, and
is allowed. Repeated rows come out as often as they went in. An empty table or
an empty list is fine, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.llm.common import only, saved

#: Blocks of the filter: 65,536 rows of 8 longs, 32 million bits, about 6 MB when broadcast.
BLOCKS = 1 << 16
#: Rules are a stated list; more belong in the list of URLs.
MAX_RULES = 10_000
SALTS = 64

# -- fixed values ------------------------------------------------------------
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change the page.
TRACKING = "(?:utm_[a-z]+|gclid|fbclid|ref)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path; both empty for null or without ``://``."""
    safe = F.coalesce(url, F.lit(""))
    at = F.instr(safe, "://")
    rest = F.when(at > 0, F.substring(safe, at + 3, F.char_length(safe))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def canonical(url: Column) -> Column:
    """``host/path?query`` without scheme, fragment, trailing slash, ``.html`` and tracking parameters."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)"))), "&"
    )
    page = F.regexp_replace(F.regexp_replace(path, "/+$", ""), r"\.html?$", "")
    return F.concat(host, page, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _bits(key: Column) -> tuple[Column, list[Column]]:
    """Block of a key and the bit it has in each of the block's eight longs."""
    block = F.pmod(F.xxhash64(F.lit(1), key), F.lit(BLOCKS)).cast("int")
    spread = F.xxhash64(F.lit(2), key)
    return block, [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(8)
    ]


def bloom_blocks(keys: DataFrame) -> DataFrame:
    """The filter of the column ``key``: block, w0 .. w7; at most ``BLOCKS`` rows."""
    block, bits = _bits(F.col("key"))
    one = keys.select(block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
    return one.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(8)])


def possible(keys: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose ``key`` the filter does not rule out."""
    block, bits = _bits(F.col("key"))
    met = keys.withColumn("block", block).join(F.broadcast(blocks), "block")
    hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(b) != 0 for i, b in enumerate(bits)])
    return met.where(hit).select(*[F.col(c) for c in keys.columns])


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    listed: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    ``rules``: (verdict, host, path). ``listed``: a table with the column
    ``key``, canonical URLs to block.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are taken")
    spark: SparkSession = pages.sparkSession
    verdicts: dict[str, str] = {}
    for verdict, host, path in rules:
        key = f"{host.translate(str.maketrans(UPPER, LOWER))}/{path.lstrip('/')}"
        verdicts[key] = max(verdict, verdicts.get(key, verdict))  # "block" over "allow"
    rule_rows = spark.createDataFrame(sorted(verdicts.items()), "key string, verdict string")
    lengths = sorted({len(key) - key.index("/") for key in verdicts})

    pages = only(pages, page_id=page_id, url=url)
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("own"))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("path"))
    as_rules = F.flatten(
        F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(F.col("path"), F.lit(1), n))))
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS - 1)).cast("int") + 1
    asked = F.concat(
        F.transform(as_rules, lambda k: F.struct(salt.alias("salt"), k.alias("key"))),
        F.array(F.struct(F.lit(0).alias("salt"), F.concat(F.lit("\n"), F.col("own")).alias("key"))),
    )
    asked = base.where("host <> ''").select("page_id", "url", F.explode(asked).alias("k")).select("page_id", "url", "k.salt", "k.key")

    # One list: rules under each salt from 1, URLs under salt 0 with a mark that no host starts with.
    listed_keys = listed.select(F.concat(F.lit("\n"), F.col("key")).alias("key")).where("key is not null").distinct()
    salted = rule_rows.select(F.explode(F.sequence(F.lit(1), F.lit(SALTS - 1))).alias("salt"), "key", "verdict")
    entries = saved(salted.unionByName(listed_keys.select(F.lit(0).alias("salt"), "key", F.lit("block").alias("verdict"))))
    blocks = bloom_blocks(entries.select("key"))

    hits = possible(asked, blocks).join(entries, ["salt", "key"])
    found = hits.select(
        "page_id", "url", F.lit(0).alias("rows"),
        F.when(F.col("salt") > 0, F.struct(F.char_length("key").alias("length"), F.col("key").alias("rule"), "verdict")).alias("rule"),
        (F.col("salt") == 0).alias("listed"),
    )
    itself = pages.select("page_id", "url", F.lit(1).alias("rows"), F.lit(None).cast(found.schema["rule"].dataType).alias("rule"), F.lit(False).alias("listed"))
    met = itself.unionByName(found).groupBy("page_id", "url").agg(
        F.sum("rows").cast("int").alias("rows"), F.max("rule").alias("rule"), F.max("listed").alias("listed")
    )
    host, path = host_and_path(F.col("url"))
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    one = F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("copy")
    return met.select(
        "page_id", host.alias("host"), path.alias("path"), F.col("rule.rule").alias("rule"), verdict.alias("verdict"), F.col("listed"), one
    ).drop("copy")
