"""Masked pseudo-likelihood: a bidirectional window network predicts every word from both sides.

Words fall into classes: the most frequent words of the whole corpus are one
each, all others are dealt to classes by hash. The network sums one embedding
per place in a window on either side, squashes the sum and predicts the class of
the word in the middle with a softmax; the corpus-wide share of the word within
its class makes that a probability of the word. A document's score is the sum of
the log-probabilities of all its words, each given its neighbours.

Word counts cover every document, and the vocabulary is every word that occurs
``least`` times, so it grows with the corpus; it stays a table, which is joined
to the words of the texts and never collected. Only the ``LISTED`` most frequent
words, a number that does not grow, are sent to the tasks with their shares, so
that the join meets what is left of the texts. Rarer words share what their
class gives to rare ones, evenly and with one share for words never seen; counts
are smoothed by ``add``. Texts are read twice, to count their words and to turn
them into classes; both passes of the network read the classes. Training
predicts every word of every document: each of the ``rounds`` rounds masks one
place in ``mask``, and the places take turns. The texts are dealt by a hash to one copy of the network per
``copy_words`` words and sorted there, so what is learnt does not depend on how
the input is cut into files. Each copy trains in numpy, starting from common
parameters, and the copies are averaged by their number of words; so the work,
and what is gathered, grow with the corpus, while the network keeps its size.
Scoring is a second pass over all whole texts.

Null and texts without words have 0 words, a sum of 0 and no mean. Repeated
rows score alike. An empty table gives an empty table; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.common import kept_in_worker, only, saved, words

#: Words with a hashed class whose share goes to the tasks; the others meet theirs in a join.
LISTED = 1 << 16
#: Parameters a row, when copies of the network are averaged.
WIDE = 32
#: Words scored together, when texts are shorter.
TOGETHER = 1 << 14


@dataclass(frozen=True)
class Network:
    frequent: int = 192
    hashed: int = 64
    side: int = 2
    hidden: int = 16
    mask: int = 2
    rounds: int = 2
    batch: int = 512
    copy_words: int = 1 << 19
    rate: float = 0.1
    least: int = 2
    add: float = 0.5
    seed: int = 11

    def __post_init__(self):
        if self.rounds < self.mask:
            raise ValueError("with fewer rounds than mask, places would never be predicted")

    @property
    def words(self) -> int:
        return self.frequent + self.hashed

    @property
    def places(self) -> list[int]:
        return [p for p in range(-self.side, self.side + 1) if p]

    @property
    def shapes(self) -> list[tuple[int, ...]]:
        return [(2 * self.side, self.words + 1, self.hidden), (self.hidden, self.words), (self.words,)]

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes)

    def start(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        flat = rng.normal(0, 0.1, self.size).astype(np.float32)
        flat[-self.words :] = 0
        return flat

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        """Embeddings by place, output weights and bias, as views of one vector."""
        out, at = [], 0
        for shape in self.shapes:
            n = int(np.prod(shape))
            out.append(flat[at : at + n].reshape(shape))
            at += n
        return out


def class_type(net: Network) -> type:
    """The smallest type of integers that holds the classes."""
    return np.uint8 if net.words <= 256 else np.uint16 if net.words <= 65_536 else np.uint32


class WordIds(dict):
    def __init__(self, own: dict[bytes, int], net: Network):
        super().__init__(own)
        self.own, self.net = own, net

    def hashed(self, word: bytes) -> int:
        return self.net.frequent + zlib.crc32(word) % self.net.hashed

    def __missing__(self, word: bytes) -> int:
        at = self.hashed(word)
        if len(word) <= 40:
            if len(self) >= 400_000:
                self.clear()
                self.update(self.own)
            self[word] = at
        return at


class Places(dict):
    """Places of listed words in ``classes`` and ``parts``; all others share the last ``hashed`` ones."""

    def __init__(self, own: dict[bytes, int], shares: dict[bytes, float], net: Network):
        listed = [*sorted(own, key=own.__getitem__), *shares]
        super().__init__(zip(listed, range(len(listed))))
        self.hashed = net.hashed
        hashed = [net.frequent + zlib.crc32(w) % net.hashed for w in shares]
        self.classes = np.array([*range(len(own)), *hashed, *range(net.frequent, net.words)], class_type(net))
        self.parts = np.array([0.0] * len(own) + list(shares.values()) + [0.0] * net.hashed)

    def of(self, found: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The places of a text's words, and those of the words that are not listed."""
        at = np.fromiter(map(self.get, found, repeat(-1)), np.int32, len(found))
        new = np.flatnonzero(at < 0)
        others = [found[i] for i in new.tolist()]
        at[new] = [len(self) + zlib.crc32(w) % self.hashed for w in others]
        return at, others


def padded(classes: np.ndarray, net: Network) -> np.ndarray:
    """A text's classes with ``side`` edge marks around."""
    out = np.full(len(classes) + 2 * net.side, net.words, np.int32)
    out[net.side : net.side + len(classes)] = classes
    return out


def padded_ids(text: str | None, ids: WordIds, net: Network) -> np.ndarray:
    """A lower-case text's padded classes; bytes split at the same separators as ``words``."""
    found = text.encode().split() if isinstance(text, str) else []
    return padded(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)), net)


def hidden_of(near: Sequence[np.ndarray], embed: np.ndarray) -> np.ndarray:
    """The hidden layer; rows of ``embed`` hold one place's classes after the other's, and ``near`` numbers them through."""
    h = embed.take(near[0], axis=0)
    for at in near[1:]:
        h += embed.take(at, axis=0)
    return np.tanh(h, out=h)


def masked(n: int, turn: int, net: Network) -> range:
    """The places of a text of ``n`` words that a round predicts; every place has its turn in ``mask`` rounds."""
    return range((turn + n) % net.mask, n, net.mask)


def train_part(texts: Iterator[str | None], flat: np.ndarray, ids: WordIds, net: Network, turn: int) -> tuple[np.ndarray, int]:
    """Parameters after one pass over the masked words of ``texts``, and the number of words seen."""
    return train_padded((padded_ids(text, ids, net) for text in texts), flat, net, turn)


def train_padded(texts: Iterable[np.ndarray], flat: np.ndarray, net: Network, turn: int) -> tuple[np.ndarray, int]:
    """``train_part`` of texts that are padded classes."""
    flat = flat.copy()
    embed = net.split(flat)[0].reshape(-1, net.hidden)
    # Weights with the bias below them, so that one product takes both.
    top = flat[embed.size :].reshape(net.hidden + 1, net.words)
    squares = np.full(net.size, 1e-3, np.float32)
    s_embed, s_top = squares[: embed.size].reshape(embed.shape), squares[embed.size :].reshape(top.shape)
    bound = np.full((net.hidden + 1, 1), 4, np.float32)
    bound[-1] = 12
    rng = np.random.default_rng((net.seed, turn))
    waiting: list[np.ndarray] = []
    held, seen = 0, 0
    firsts = np.arange(2 * net.side)[:, None] * (net.words + 1)
    cells, ones = np.arange(embed.size).reshape(embed.shape), np.ones(net.words, np.float32)

    def step(block: np.ndarray) -> None:
        near, word = block[:-1] + firsts, block[-1]
        n = len(word)
        h = np.ones((n, net.hidden + 1), np.float32)
        h[:, :-1] = hidden_of(near, embed)
        p = h @ top
        np.exp(p, out=p)  # weights are clipped, so this stays finite
        # Not normalised: the narrow factors of the products are scaled instead.
        sums = p @ ones
        p[np.arange(n), word] -= sums
        per = 1 / (n * sums)[:, None]
        g_top = np.multiply(h.T, per.T, order="C") @ p
        h = h[:, :-1]
        back = (p @ top[:-1].T) * per * (1 - h * h)
        g = np.zeros(embed.size, np.float32)
        np.add.at(g, cells.take(near, axis=0).ravel(), np.broadcast_to(back, (len(near), *back.shape)).ravel())
        g = g.reshape(embed.shape)
        s_embed[:] += g * g
        embed[:] -= net.rate * g / np.sqrt(s_embed)
        s_top[:] += g_top * g_top
        top[:] = np.clip(top - net.rate * g_top / np.sqrt(s_top), -bound, bound)

    for x in texts:
        n = len(x) - 2 * net.side
        if not n:
            continue
        seen += n
        at = masked(n, turn, net)
        if len(at):
            rows = np.empty((len(net.places) + 1, len(at)), x.dtype)
            for i, p in enumerate([*net.places, 0]):
                rows[i] = x[net.side + p + at.start : net.side + p + n : net.mask]
            waiting.append(rows)
            held += len(at)
        if held >= 8 * net.batch:
            rows = np.concatenate(waiting, axis=1)
            rows = rows.take(rng.permutation(rows.shape[1]), axis=1)
            for i in range(0, rows.shape[1] - net.batch + 1, net.batch):
                step(rows[:, i : i + net.batch])
            rest = rows.shape[1] % net.batch
            waiting, held = ([rows[:, -rest:]], rest) if rest else ([], 0)
    if held:
        rows = np.concatenate(waiting, axis=1)
        rows = rows[:, rng.permutation(rows.shape[1])]
        for i in range(0, rows.shape[1], net.batch):
            step(rows[:, i : i + net.batch])
    return flat, seen


def log_probabilities(x: np.ndarray, parts: list[np.ndarray], net: Network) -> float:
    """Sum over all words of one padded text."""
    return float(sums_together([x], parts, net)[0])


def sums_together(texts: Sequence[np.ndarray], parts: list[np.ndarray], net: Network, block: int = 256) -> np.ndarray:
    """Sum over all words of each padded text; the texts' words go through the network together."""
    embed, out, bias = parts
    embed, top, ones = embed.reshape(-1, net.hidden), np.vstack([out, bias]), np.ones(net.words, np.float32)
    x = np.concatenate(texts)
    at = np.flatnonzero(x != net.words)
    near, own = [x[at + p] + i * (net.words + 1) for i, p in enumerate(net.places)], x[at]
    logs = np.empty(len(at), np.float32)
    h, z = np.ones((block, net.hidden + 1), np.float32), np.empty((block, net.words), np.float32)
    for start in range(0, len(at), block):
        n = min(block, len(at) - start)
        here = slice(start, start + n)
        h[:n, :-1] = hidden_of([w[here] for w in near], embed)
        np.matmul(h[:n], top, out=z[:n])
        chosen = z[np.arange(n), own[here]]
        np.exp(z[:n], out=z[:n])  # weights are clipped, so this stays finite
        logs[here] = chosen - np.log(z[:n] @ ones)
    owner = np.repeat(np.arange(len(texts)), [len(t) - 2 * net.side for t in texts])
    return np.bincount(owner, weights=logs, minlength=len(texts))


def sums(texts: Iterable[np.ndarray], parts: list[np.ndarray], net: Network) -> np.ndarray:
    """``sums_together`` of any number of padded texts, about ``TOGETHER`` words at a time."""
    waiting: list[np.ndarray] = []
    found, held = [np.zeros(0)], 0
    for x in texts:
        waiting.append(x)
        held += len(x)
        if held >= TOGETHER:
            found.append(sums_together(waiting, parts, net))
            waiting, held = [], 0
    if waiting:
        found.append(sums_together(waiting, parts, net))
    return np.concatenate(found)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of the lower-case texts."""
    return saved(docs.select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n")))


def frequent_words(counts: DataFrame, net: Network) -> dict[bytes, int]:
    """Classes of the corpus's most frequent words."""
    top = counts.where(F.char_length("word") <= 40).orderBy(F.desc("n"), "word").limit(net.frequent).collect()
    return {r["word"].encode(): i for i, r in enumerate(top)}


def _hashed(word: Column, own: dict[bytes, int]) -> Column:
    return ~word.isin([w.decode() for w in own]) if own else F.lit(True)


def word_shares(counts: DataFrame, own: dict[bytes, int], net: Network) -> tuple[DataFrame, DataFrame]:
    """(class, whole, of_rare) and (word, of_word, n): log P(word | class) is ``of_word``, or ``of_rare`` of a rarer word, less ``whole``."""
    usual, rare = F.col("n") >= net.least, F.col("n") < net.least
    sizes = counts.where(_hashed(F.col("word"), own)).groupBy(_class(F.col("word"), net).alias("class")).agg(
        F.sum("n").alias("all"), F.count_if(usual).alias("usual"),
        F.coalesce(F.sum(F.when(rare, F.col("n"))), F.lit(0)).alias("rest"), F.count_if(rare).alias("rare"),
    )
    whole = F.col("all") + net.add * (F.col("usual") + 1)
    of_class = sizes.select("class", F.log(whole).alias("whole"), F.log((F.col("rest") + net.add) / (F.col("rare") + 1)).alias("of_rare"))
    return saved(of_class), counts.where(usual).select("word", F.log(F.col("n") + net.add).alias("of_word"), "n")


def _class(word: Column, net: Network) -> Column:
    """Which of the hashed classes, from 0."""
    return F.pmod(F.crc32(word.cast("binary")), F.lit(net.hashed)).cast("int")


def listed_shares(of_class: DataFrame, of_words: DataFrame, own: dict[bytes, int], net: Network) -> dict[bytes, float]:
    """log P(word | class) of the most frequent words with a hashed class, ``LISTED`` at most."""
    top = of_words.where(_hashed(F.col("word"), own) & (F.char_length("word") <= 40)).orderBy(F.desc("n"), "word").limit(LISTED)
    top = top.withColumn("class", _class(F.col("word"), net)).join(F.broadcast(of_class), "class")
    return {r["word"].encode(): r["part"] for r in top.select("word", (F.col("of_word") - F.col("whole")).alias("part")).collect()}


def coded(docs: DataFrame, own: dict[bytes, int], shares: dict[bytes, float], net: Network) -> DataFrame:
    """(deal, row, doc_id, n_words, classes, within, others) of lower-case texts.

    ``within`` sums the shares of the listed words; ``others`` are the words
    that are neither listed nor have a class of their own, with a space between.
    """
    shipped, run = docs.sparkSession.sparkContext.broadcast((own, shares)), uuid.uuid4().hex

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = kept_in_worker("words of lm_score", dict)
        if run not in held:
            held.clear()
            held[run] = Places(*shipped.value, net)
        places = held[run]
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = text.encode().split() if isinstance(text, str) else []
                at, others = places.of(found)
                out.append((len(found), places.classes[at].tobytes(), float(places.parts[at].sum()), b" ".join(others).decode()))
            more = pd.DataFrame(out, columns=["n_words", "classes", "within", "others"], index=batch.index)
            yield pd.concat([batch[["deal", "row"]], batch["doc_id"].astype("Int64"), more], axis=1)

    rows = docs.select(F.xxhash64("doc_id", "text").alias("deal"), F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return saved(rows.mapInPandas(code, "deal long, row long, doc_id long, n_words long, classes binary, within double, others string"))


def within_others(codes: DataFrame, of_class: DataFrame, of_words: DataFrame, net: Network) -> DataFrame:
    """(row, more): the sum of log P(word | class) over a text's words that are not listed."""
    each = codes.where("others <> ''").select("row", F.explode(F.split("others", " ")).alias("word"))
    each = each.join(of_words.select("word", "of_word").hint("shuffle_hash"), "word", "left").withColumn("class", _class(F.col("word"), net))
    each = each.join(F.broadcast(of_class), "class", "left")
    return each.groupBy("row").agg(F.sum(F.coalesce("of_word", "of_rare") - F.col("whole")).alias("more"))


def train(docs: DataFrame, own: dict[bytes, int], net: Network, n_words: int) -> np.ndarray:
    """``train_coded`` of lower-case texts (doc_id, text)."""
    return train_coded(coded(docs, own, {}, net), net, n_words)


def train_coded(codes: DataFrame, net: Network, n_words: int) -> np.ndarray:
    """Parameters averaged over the copies that the partitions train; ``n_words`` is the corpus's number of words."""
    codes = codes.select("deal", "doc_id", "classes").repartition(max(1, -(-n_words // net.copy_words)), "deal")
    codes = codes.sortWithinPartitions("deal", "doc_id", "classes")
    flat, values = net.start(), [f"v{i}" for i in range(WIDE)]
    for turn in range(net.rounds):
        shipped = codes.sparkSession.sparkContext.broadcast(flat)

        def fit(batches: Iterator[pd.DataFrame], shipped=shipped, turn=turn) -> Iterator[pd.DataFrame]:
            texts = (padded(np.frombuffer(c, class_type(net)), net) for batch in batches for c in batch["classes"])
            trained, seen = train_padded(texts, shipped.value, net, turn)
            if seen:
                rows = np.pad(trained, (0, -len(trained) % WIDE)).reshape(-1, WIDE)
                yield pd.DataFrame(rows, columns=values).assign(at=np.arange(len(rows)), seen=seen)

        copies = codes.select("classes").mapInPandas(fit, ", ".join(f"{v} float" for v in values) + ", at int, seen long")
        mean = copies.groupBy("at").agg(*[(F.sum(F.col(v) * F.col("seen")) / F.sum("seen")).alias(v) for v in values])
        flat = np.pad(flat, (0, -net.size % WIDE))
        for row in mean.collect():  # as many values as the network has parameters
            flat[row["at"] * WIDE : (row["at"] + 1) * WIDE] = [row[v] for v in values]
        flat = flat[: net.size]
    return flat


def score(docs: DataFrame, net: Network = Network()) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_prob) of every document."""
    docs = only(docs, doc_id="doc_id", text="text").select("doc_id", F.lower("text").alias("text"))
    counts = word_counts(docs)
    own = frequent_words(counts, net)
    n_words = counts.agg(F.sum("n")).first()[0] or 0
    of_class, of_words = word_shares(counts, own, net)
    codes = coded(docs, own, listed_shares(of_class, of_words, own, net), net)
    shipped = docs.sparkSession.sparkContext.broadcast(train_coded(codes, net, n_words))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = net.split(shipped.value)
        for batch in batches:
            of_classes = sums((padded(np.frombuffer(c, class_type(net)), net) for c in batch["classes"]), parts, net)
            out = batch[["row", "n_words"]].assign(total=of_classes + batch["within"])
            yield out.assign(doc_id=batch["doc_id"].astype("Int64"))[["row", "doc_id", "n_words", "total"]]

    scored = codes.select("row", "doc_id", "n_words", "classes", "within").mapInPandas(apply, "row long, doc_id long, n_words long, total double")
    scored = scored.join(within_others(codes, of_class, of_words, net), "row", "left")
    scored = scored.select("doc_id", "n_words", (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))
    return scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
