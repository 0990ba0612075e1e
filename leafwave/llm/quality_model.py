"""Quality from weak labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer.

Each labeller looks at one trait of a text and votes good (1), bad (0) or
abstains (-1). How often each pattern of votes occurs is counted over all
documents; there are at most 3 ** labellers patterns, whatever the corpus, and
expectation-maximisation on these counts estimates how a labeller votes on good
and on bad documents and how many are good. That gives each pattern, and so
each document, a posterior.

The posteriors of a bounded sample of documents, at most ``sample`` of them,
the first by a hash of the text, train a logistic scorer over hashed traits of
words, lines and neighbouring words. It generalises beyond the thresholds of
the labellers and scores every whole text.

No given label is used. Null and empty texts have no words: the length labeller
calls them bad and the others abstain. Repeated rows score alike. An empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.common import SPACES, WORD, once, only, saved, words
from leafwave.llm.quality_rules import CLOSING_MARKS, ODD_MARKS, SEPARATORS, _any_of

LABELLERS = ("length", "marks", "closing", "stutter", "capitals", "separators", "lines", "variety")


@dataclass(frozen=True)
class Scorer:
    """``sample`` bounds the training rows of the scorer."""

    buckets: int = 1 << 16
    sample: int = 4000
    epochs: int = 30
    rate: float = 0.05
    keep_at: float = 0.5


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1)).otherwise(F.lit(-1)).cast("tinyint")


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, text, votes): one vote per labeller, in their order."""
    rows = only(docs, doc_id="doc_id", text="text")
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumns({"w": words(t), "lines": F.split(t, "\n")})
    w = F.col("w")
    rows = rows.withColumns(
        {
            "n": F.size(w),
            "lines": F.filter("lines", lambda x: x.rlike(WORD)),
            "solid": F.char_length(F.array_join(w, "")),
            "odd": F.regexp_count(t, F.lit(_any_of(ODD_MARKS))) + F.regexp_count(t, F.lit(r"[!?]{2,}")) * 2,
            "bars": F.regexp_count(t, F.lit(_any_of(SEPARATORS))),
            "capital": F.regexp_count(t, F.lit(r"\p{Lu}")),
            "again": F.size(F.filter(F.transform(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False))), lambda x: x)),
            "kinds": F.size(F.array_distinct(w)),
        }
    )
    closed = F.size(F.filter("lines", lambda x: F.lit(CLOSING_MARKS).contains(F.right(F.rtrim(x, F.lit(SPACES)), F.lit(1)))))
    n, n_lines = F.col("n"), F.size("lines")
    some = n > 0
    copies = n_lines - F.size(F.array_distinct("lines"))
    cast = _vote(n < 20, n >= 50), \
        _vote(some & (F.col("odd") > 0.08 * F.col("solid")), some & (F.col("odd") < 0.03 * F.col("solid"))), \
        _vote(some & (closed < 0.5 * n_lines), some & (closed >= 0.8 * n_lines)), \
        _vote(some & (F.col("again") > 0.2 * n), (n >= 20) & (F.col("again") < 0.05 * n)), \
        _vote(some & (F.col("capital") > 0.5 * F.col("solid")), some & (F.col("capital") < 0.2 * F.col("solid"))), \
        _vote(some & (F.col("bars") > 0.2 * n), some & (F.col("bars") == 0)), \
        _vote(some & (copies > 0.3 * n_lines), (n_lines >= 3) & (copies == 0)), \
        _vote((n >= 50) & (F.col("kinds") < 0.2 * n), (n >= 50) & (F.col("kinds") > 0.35 * n))
    return rows.select("doc_id", "text", once(F.array(*cast)).alias("votes"))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over (patterns, counts): P(vote | class) as [class, labeller, vote + 1], posteriors of good, share of good.

    An abstention says nothing; a labeller counts as better than chance on good documents.
    """
    n = patterns.shape[1]
    good, bad = (patterns == 1).sum(axis=1), (patterns == 0).sum(axis=1)
    posterior = np.clip((good + 1.0) / (good + 4.0 * bad + 2.0), 0.02, 0.98)  # bad votes are rarer and tell more
    chance = np.ones((2, n, 3))
    share = 0.5
    hot = np.stack([np.zeros_like(patterns), patterns == 0, patterns == 1], axis=2).astype(float)
    for _ in range(rounds):
        for c, belief in enumerate((1 - posterior, posterior)):
            mass = np.einsum("p,pnv->nv", counts * belief, hot)[:, 1:] + 0.5
            chance[c, :, 1:] = mass / mass.sum(axis=1, keepdims=True)
        chance[1, :, 2] = np.maximum(chance[1, :, 2], 0.5)
        chance[1, :, 1] = 1 - chance[1, :, 2]
        share = float((counts * posterior).sum() + 1) / float(counts.sum() + 2)
        logs = np.einsum("pnv,cnv->pc", hot, np.log(chance)) + np.log([1 - share, share])
        now = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        moved = float(np.abs(now - posterior).max())
        posterior = now
        if moved < 1e-9:
            break
    return chance, posterior, share


def posteriors(voted: DataFrame) -> tuple[np.ndarray, float]:
    """Vote probabilities and share of good from all documents' vote patterns."""
    table = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # at most 3 ** labellers rows
    if not table:
        return np.ones((2, len(LABELLERS), 3)), 0.5
    chance, _, share = estimate(np.array([r["votes"] for r in table]), np.array([r["n"] for r in table], float))
    return chance, share


def posterior_of(chance: np.ndarray, share: float) -> Column:
    """Posterior of good, as an expression over ``votes``."""
    total = F.lit(float(np.log(share) - np.log(1 - share)))
    for i in range(len(LABELLERS)):
        weights = np.log(chance[1, i]) - np.log(chance[0, i])
        total = total + F.get(F.array(*[F.lit(float(x)) for x in weights]), F.get("votes", F.lit(i)).cast("int") + 1)
    return 1 / (1 + F.exp(-total))


_SHAPES = (re.compile(r"[^\W\d_a-z]"), re.compile(r"[a-z]+"), re.compile(r"\d+"))


def traits(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed traits of a text and their weights."""
    counts: Counter = Counter()
    for line in text.split("\n"):
        found = line.split()
        if not found:
            continue
        counts[f"end {found[-1][-1]}"] += 1
        counts["lines"] += 1
        before = None
        for w in found:
            if w == before:
                counts["again"] += 1
            elif len(w) > 2:
                counts[f"tail {w[-3:]}"] += 1
            if not w.isalpha():
                counts[f"marks {''.join(c for c in w if not c.isalnum())[:4]}"] += 1
            if w.isupper():
                counts["upper"] += 1
            before = w
    total = sum(counts.values())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.array([xxhash.xxh32_intdigest(k) % buckets for k in counts], np.int64)
    return at, np.sqrt(np.array(list(counts.values())) / total)


def learn(texts: list[str], targets: np.ndarray, how: Scorer) -> tuple[np.ndarray, float]:
    """Logistic weights and bias for soft targets, by full-batch Adam."""
    rows = [traits(t, how.buckets) for t in texts]
    owner = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    at = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, np.int64)
    x = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    w, b = np.zeros(how.buckets + 1), how.buckets
    first, second = np.zeros_like(w), np.zeros_like(w)
    for turn in range(1, how.epochs * 10 + 1):
        z = np.bincount(owner, x * w[at], len(rows)) + w[b]
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - targets) / max(1, len(rows))
        g = np.append(np.bincount(at, x * off[owner], how.buckets), off.sum()) + 1e-6 * w
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= how.rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return w[: how.buckets].astype(np.float32), float(w[b])


def score(docs: DataFrame, how: Scorer = Scorer()) -> DataFrame:
    """(doc_id, posterior, score, kept): the weak label's and the scorer's probability of good, and the scorer's verdict."""
    voted = saved(votes(docs).withColumn("turn", F.xxhash64("doc_id", "text")))
    chance, share = posteriors(voted)
    judged = voted.select("doc_id", "text", "turn", posterior_of(chance, share).alias("posterior"))
    # The sample's last turn is found on bare numbers, so few texts beyond the sample are moved.
    last = voted.select("turn").orderBy("turn").limit(how.sample).agg(F.max("turn").alias("turn")).collect()[0]["turn"]
    sample = judged.where(F.col("turn") <= F.lit(last)).orderBy("turn", "doc_id").limit(how.sample)
    sample = sample.select(F.lit(0).alias("one"), "doc_id", "text", "posterior")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else "" for t in rows["text"]]
        w, b = learn(texts, rows["posterior"].to_numpy(), how)
        return pd.DataFrame({"weights": [w.astype("<f4").tobytes()], "bias": [b]})

    model = sample.groupBy("one").applyInPandas(fit, "weights binary, bias double").collect()
    weights = np.frombuffer(bytes(model[0]["weights"]), "<f4") if model else np.zeros(how.buckets, np.float32)
    bias = model[0]["bias"] if model else 0.0
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shipped.value
        for batch in batches:
            z = np.empty(len(batch))
            for i, text in enumerate(batch["text"]):
                at, x = traits(text if isinstance(text, str) else "", how.buckets)
                z[i] = bias + float(w[at] @ x)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "posterior": batch["posterior"], "score": p})

    scored = judged.drop("turn").mapInPandas(apply, "doc_id long, posterior double, score double")
    return scored.withColumn("kept", F.col("score") >= how.keep_at)
