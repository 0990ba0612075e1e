"""All filter orders against applying the filters one after the other."""

import collections
import itertools
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from leafwave.llm import filter_audit
from leafwave.llm.queries import QUERIES

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed(text):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    out = set()
    if len(w) < 200:
        out.add("A")
    if 100 * len(set(w)) < 50 * len(w):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels):
    """(doc_id, text, source) rows; every order applied to every part's documents."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        f = failed(t or "")
        if i is not None and i > least[t or ""]:
            f.add("E")
        good, toxic = (any(x[k] == 1 for x in labels if i is not None and x[0] == i) for k in (1, 2))
        parts[s or ""].append((f, good, toxic))
    out = []
    for part, docs in parts.items():
        shares = collections.Counter()
        own = []
        for order in itertools.permutations("ABCDE"):
            left, gone = docs, []
            for step, letter in enumerate(order, 1):
                here = [d for d in left if letter in d[0]]
                redundant = sum(letter in d[0] for d in gone)
                left, gone = [d for d in left if letter not in d[0]], gone + here
                shares[letter] += len(here)
                unique = sum(d[0] == {letter} for d in docs)
                own.append((part, "".join(order), step, len(left), len(here), redundant, unique, sum(d[1] for d in here), sum(d[2] for d in here)))
        out += [r + (shares[r[1][r[2] - 1]],) for r in own]
    return sorted(out)


def test_query_equals_applying_the_filters(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = QUERIES["op12_filter_audit"](spark, sf)
    assert got.columns == COLUMNS
    want = brute([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark):
    rng = random.Random(4)
    many = " ".join(f"w{i}" for i in range(300))
    texts = [None, "", many, many + " 50%", "A B", "word " * 250, many.upper(), "# " * 9, " Ä" * 3]
    rows = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice([None, "", "a", "b"]), 1) for _ in range(150)]
    rows += rows[:30]
    labels = [(i, rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for i in range(20)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS part")
    got = sorted(map(tuple, filter_audit.audit(docs, marks).collect()))
    assert got == brute([r[:3] for r in rows], labels)
    assert filter_audit.audit(docs.limit(0), marks).collect() == []
    alone = filter_audit.audit(docs.limit(1), marks.limit(0)).collect()
    assert len(alone) == 600


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.tuples(*[st.integers(0, 9)] * 3), min_size=1))
def test_swapped_levels_hold_the_same_counts(weights):
    """After any swaps the walk agrees with counting masks, and every order comes once."""
    n = 5
    d = filter_audit.Diagram(n, weights)
    seen = {tuple(d.levels)}
    for level in filter_audit.level_swaps(n):
        d.swap(level)
        seen.add(tuple(d.levels))
        before = 0
        for f, left, gone in d.steps():
            here = [w for m, w in weights.items() if not m & before and m >> f & 1]
            before |= 1 << f
            rest = [w for m, w in weights.items() if not m & before]
            assert gone == tuple(sum(w[k] for w in here) for k in range(3)) and left == tuple(sum(w[k] for w in rest) for k in range(3))
    assert len(seen) == 120


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 6])
def test_swaps_meet_all_orders(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in filter_audit.level_swaps(n):
        order[at : at + 2] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))
