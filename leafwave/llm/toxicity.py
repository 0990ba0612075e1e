"""Toxicity: averaged subword embeddings into a linear softmax, trained jointly.

A word is the bag of its character n-grams, with marks at its ends, and itself;
n-grams are hashed to buckets, each with a small embedding. A text is the
average over the n-grams of its words, a word that occurs c times weighing
sqrt(c), so that stuttering does not drown the rest; a linear softmax turns
that into the probability of the label. Misspelled or inflected forms share most n-grams
with what was seen in training and so most of its weight.

Embeddings and softmax are trained together by Adam, in numpy, on a bounded
sample of labelled rows: at most ``per_class`` of each class, the first by a
hash of the id. Where that keeps another share of one class than of the other,
the bias is moved back by the log of the ratio, with both classes counted over
all labelled rows, so that scores do not depend on where the bound starts to
hold. One task trains; the model has a fixed size, a few megabytes,
and is what travels to the scoring tasks. There a word's n-grams are summed
once and remembered, so scoring is a pass over the words of every whole text.

Rows whose crc32 of the id modulo 4 is 2 are held out: their labels are never
learnt. Scores use the text alone. Null and empty texts have no n-grams and get
the score of the bias. A null id is not held out, and not learnt from. Repeated
rows score alike; several labels of an id count as toxic if any does. Without a
labelled row of both classes every score is the share of label 1, or 0. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.common import only

THRESHOLD = 0.3
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Subwords:
    """``per_class`` bounds the training sample; ``scale`` keeps averaged vectors at a trainable size."""

    shortest: int = 3
    longest: int = 5
    buckets: int = 1 << 17
    dimensions: int = 8
    per_class: int = 5000
    epochs: int = 6
    batch: int = 256
    rate: float = 0.05
    scale: float = 30.0
    seed: int = 7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def ngrams(word: str, how: Subwords) -> list[int]:
    """Buckets of a word's n-grams; very long words give theirs like any other."""
    marked = f"<{word}>"
    out = [xxhash.xxh32_intdigest(marked) % how.buckets]
    for n in range(how.shortest, how.longest + 1):
        out += [xxhash.xxh32_intdigest(marked[i : i + n]) % how.buckets for i in range(len(marked) - n + 1)]
    return out


class WordNgrams(dict):
    """N-grams of words, remembered for the common lengths."""

    def __init__(self, how: Subwords):
        super().__init__()
        self.how = how

    def __missing__(self, word: str) -> np.ndarray:
        found = np.array(ngrams(word, self.how), np.int64)
        if len(word) <= 40:
            if len(self) >= 200_000:
                self.clear()
            self[word] = found
        return found


def bags(texts: list[str], how: Subwords) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bags in rows: starts, buckets, and each bucket's share of its text."""
    seen = WordNgrams(how)
    starts, ids, shares = [0], [], []
    for text in texts:
        counts = Counter(WORD.findall(text.lower()))
        parts = [seen[w] for w in counts]
        if parts:
            bucket, place = np.unique(np.concatenate(parts), return_inverse=True)
            weight = np.repeat(np.sqrt(list(counts.values())), [len(p) for p in parts])
            ids.append(bucket)
            shares.append((np.bincount(place, weight) / weight.sum()).astype(np.float32))
        starts.append(starts[-1] + (len(ids[-1]) if parts else 0))
    if not ids:
        return np.array(starts), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return np.array(starts), np.concatenate(ids), np.concatenate(shares)


def train(texts: list[str], labels: np.ndarray, how: Subwords) -> tuple[np.ndarray, float]:
    """Per bucket the difference of the softmax's two logits, and that of the bias."""
    share = float(np.mean(labels)) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return np.zeros(how.buckets, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    rng = np.random.default_rng(how.seed)
    starts, ids, shares = bags(texts, how)
    size = np.diff(starts)
    embed = rng.normal(0, 0.1, (how.buckets, how.dimensions)).astype(np.float32)
    head = rng.normal(0, 0.1, (how.dimensions, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    params = [embed, head, bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    turn = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), how.batch):
            rows = order[at : at + how.batch]
            n = size[rows]
            nonzero = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in rows]) if n.sum() else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(rows)), n)
            bucket, part = ids[nonzero], shares[nonzero] * how.scale
            mean = np.stack(
                [np.bincount(owner, part * embed[bucket, d], len(rows)) for d in range(how.dimensions)], axis=1
            ).astype(np.float32)
            logits = mean @ head + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p /= len(rows)
            back = p @ head.T
            used, place = np.unique(bucket, return_inverse=True)
            g_embed = np.stack(
                [np.bincount(place, part * back[owner, d], len(used)) for d in range(how.dimensions)], axis=1
            ).astype(np.float32)
            turn += 1
            fix1, fix2 = 1 - 0.9**turn, 1 - 0.999**turn
            for param, m, v, g, where in (
                (embed, first[0], second[0], g_embed, used),
                (head, first[1], second[1], mean.T @ p, slice(None)),
                (bias, first[2], second[2], p.sum(axis=0), slice(None)),
            ):
                m[where] = 0.9 * m[where] + 0.1 * g
                v[where] = 0.999 * v[where] + 0.001 * g * g
                param[where] -= how.rate * (m[where] / fix1) / (np.sqrt(v[where] / fix2) + 1e-8)
    weights = (embed @ (head[:, 1] - head[:, 0])) * how.scale
    return weights.astype(np.float32), float(bias[1] - bias[0])


class WordScores(dict):
    """Sum of a word's n-gram weights (real), and their number (imaginary)."""

    def __init__(self, weights: np.ndarray, how: Subwords):
        super().__init__()
        self.weights, self.how = weights, how

    def __missing__(self, word: str) -> complex:
        at = ngrams(word, self.how)
        found = complex(float(self.weights[at].sum()), len(at))
        if len(word) <= 40:
            if len(self) >= 400_000:
                self.clear()
            self[word] = found
        return found

    def logit(self, text: str, bias: float) -> float:
        """Of a whole text; of one without words, the bias."""
        total = sum((self[w] * sqrt(n) for w, n in Counter(WORD.findall(text.lower())).items()), 0j)
        return bias + (total.real / total.imag if total.imag else 0.0)


def prior_shift(n1: int, n0: int, sampled1: int, sampled0: int) -> float:
    """What moves a logit learnt from a sample of each class to the classes' shares among all labelled rows."""
    return float(np.log((n1 / n0) / (sampled1 / sampled0))) if min(n1, n0, sampled1, sampled0) > 0 else 0.0


def fit(docs: DataFrame, labels: DataFrame, how: Subwords = Subwords()) -> tuple[np.ndarray, float]:
    """Weights and bias from a bounded sample of the labelled rows that are not held out."""
    marks = only(labels, doc_id="doc_id", toxic="toxic").where("doc_id is not null and toxic in (0, 1)")
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(how.seed))
    texts = only(docs, doc_id="doc_id", text="text").where("text is not null")
    counted = texts.select("doc_id").join(marks, "doc_id").agg(
        *[F.count_distinct(F.when(F.col("toxic") == k, F.col("doc_id"))).alias(f"n{k}") for k in (0, 1)]
    ).first()
    sample = marks.where("toxic = 1").orderBy(order, "doc_id").limit(how.per_class)
    sample = sample.unionByName(marks.where("toxic = 0").orderBy(order, "doc_id").limit(how.per_class))
    # At most 2 * per_class short rows.
    rows = texts.join(F.broadcast(sample), "doc_id")
    rows = rows.dropDuplicates(["doc_id"]).select(F.lit(0).alias("one"), "doc_id", "text", "toxic")

    def learn(sampled: pd.DataFrame) -> pd.DataFrame:
        sampled = sampled.sort_values("doc_id")
        toxic = sampled["toxic"].to_numpy(np.int64)
        weights, bias = train(list(sampled["text"]), toxic, how)
        bias += prior_shift(counted["n1"], counted["n0"], int(toxic.sum()), int((toxic == 0).sum()))
        return pd.DataFrame({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})

    model = rows.groupBy("one").applyInPandas(learn, "weights binary, bias double").collect()
    if not model:
        return train([], np.zeros(0, np.int64), how)
    return np.frombuffer(bytes(model[0]["weights"]), "<f4"), model[0]["bias"]


def score(docs: DataFrame, labels: DataFrame, how: Subwords = Subwords(), threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    weights, bias = fit(docs, labels, how)
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = WordScores(shipped.value, how)
        for batch in batches:
            out = np.array([seen.logit(t if isinstance(t, str) else "", bias) for t in batch["text"]])
            probability = 1 / (1 + np.exp(-np.clip(out, -500, 500)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": probability})

    scored = only(docs, doc_id="doc_id", text="text").mapInPandas(logits, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
