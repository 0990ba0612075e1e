"""The text operators against brute force, on small tables and on edge cases."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("leafwave.llm")

import corpus_pipeline  # noqa: E402
from leafwave.llm import lm_score, mixing, near_dedup, packing, pii, quality_model, quality_rules, topk_search, toxicity, url_filter  # noqa: E402
from leafwave.llm.queries import ORACLES, PII_KEY, QUERIES, RULES, tokenizer_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i}" for i in range(60)) + ". "


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def odd_docs(spark, rows=None):
    """Null, empty, long, equal and repeated rows, nulls in every column, and names that clash."""
    rows = rows if rows is not None else [
        (1, PROSE, "en", "a", len(PROSE)), (2, PROSE, "en", "b", len(PROSE)), (2, PROSE, "en", "b", len(PROSE)),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \n\t ", "en", "a", 4), (None, "a b", "en", None, 3),
        (None, None, None, None, None), (6, "x" * 50_000, "en", "a", 50_000), (7, PROSE * 60, "de", "c", len(PROSE) * 60),
        (8, "Zwei Zeilen.\nkurz", "de", "c", 17),
    ]
    df = spark.createDataFrame(rows, DOCS)
    extra = ("node", "bucket", "size", "key", "label", "block", "w", "lines", "rank", "target", "score", "kind")
    return df.withColumns({c: F.lit("clash") for c in extra})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = [collections.Counter(tuple(str(x) for x in r) for r in d[sorted(want.columns)].astype(object).where(d[sorted(want.columns)].notna(), None).itertuples(index=False)) for d in (got, want)]
    assert rows[0] == rows[1]


EDGE = {
    "quality": lambda s, d: quality_rules.judge_lines(d).select("doc_id", "rules.*"),
    "clean": lambda s, d: quality_rules.keep_clean(d),
    "mix": lambda s, d: mixing.mix(d).select("doc_id", "mix.*"),
    "emit": lambda s, d: mixing.emit(d),
    "near": lambda s, d: near_dedup.classes(d),
    "first": lambda s, d: near_dedup.keep_first(d),
    "pii": lambda s, d: pii.pseudonymise(d, "k"),
    "packing": lambda s, d: packing.pack(d, tokenizer_path()),
    "weak": lambda s, d: quality_model.score(d),
    "lm": lambda s, d: lm_score.score(d),
    "toxic": lambda s, d: toxicity.score(d, s.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (7, 0)], "doc_id long, toxic int")),
}
ROW_FOR_ROW = {"quality", "mix", "near", "pii", "weak", "lm", "toxic"}


@pytest.mark.parametrize("name", sorted(EDGE))
def test_odd_rows_and_empty_tables(spark, name):
    docs = odd_docs(spark)
    got = EDGE[name](spark, docs).collect()
    if name in ROW_FOR_ROW:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())
    assert EDGE[name](spark, odd_docs(spark, [])).collect() == []


def test_edge_values(spark):
    docs = odd_docs(spark)
    classes = collections.defaultdict(set)
    for r in near_dedup.classes(docs).collect():
        classes[r["doc_id"]].add(r["class_id"])
    assert classes[1] == classes[2] == {1} and classes[3] == {3} and classes[4] == {4} and classes[7] == {7}
    kept = [r["doc_id"] for r in near_dedup.keep_first(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 3, 4, 5, None, None, 6, 7, 8]))
    rules = {r["doc_id"]: r["rules"] for r in quality_rules.judge_lines(docs).collect()}
    assert rules[1]["kept"] and not rules[3]["kept"] and rules[3]["n_words"] == 0 and rules[7]["n_repeat_words"] == rules[7]["n_words"]
    lm = {r["doc_id"]: r for r in lm_score.score(docs).collect()}
    assert lm[3]["n_words"] == 0 and lm[3]["log_likelihood"] == 0 and lm[3]["mean_log_prob"] is None and lm[1]["log_likelihood"] < 0


# -- near duplicates ------------------------------------------------------------


def shingles(text):
    w = text.lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = sum((sets[a] & sets[b]).values())
            if texts[a] == texts[b] or both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both) > 0:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in texts}


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == brute_classes(texts)


@pytest.mark.parametrize("alone", [0, 2, 6])
def test_large_mixed_buckets_lose_no_link(spark, monkeypatch, alone):
    """Texts that share a long passage, some of them near copies of each other; ``alone`` rounds of stars come first."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(160)]
    texts = {}
    for i in range(60):
        own = [f"u{i}x{j}" for j in range(int(rng.integers(15, 40)))]
        texts[3 * i] = " ".join(passage + own)
        if i % 2:
            own[int(rng.integers(len(own)))] = f"edit{i}"
            texts[3 * i + 1] = " ".join(passage + own)
        if i % 5 == 0:
            texts[3 * i + 2] = " ".join(passage + own + [f"more{i}x{j}" for j in range(30)])
    want = brute_classes(texts)
    assert 10 < len(set(want.values())) < len(want)
    seen = []
    rarest = near_dedup.rarest_elements
    monkeypatch.setattr(near_dedup, "ALONE", alone)
    monkeypatch.setattr(near_dedup, "rarest_elements", lambda *a: seen.append(a[0].count()) or rarest(*a))
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == want and sum(seen)


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    common = rng.integers(0, 2**63, 700).astype(np.uint64)
    a = np.concatenate([common, rng.integers(0, 2**63, 150).astype(np.uint64)])
    b = np.concatenate([common, rng.integers(0, 2**63, 150).astype(np.uint64)])
    sa, sb, one = near_dedup.dart_signatures([a, b, a[:1]], 2000)
    assert abs((sa == sb).mean() - 0.7) < 0.04 and len(set(one)) == 2000


def test_large_group_around_one_original(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):  # each near the original, hardly any near another
        words = list(base)
        for p in rng.choice(200, 3, replace=False):
            words[p] = f"n{i}x{p}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in near_dedup.classes(docs).collect()} == {0}


def test_only_texts_in_a_pair_send_their_elements(spark, monkeypatch):
    sent, possible = [], near_dedup.possible
    monkeypatch.setattr(near_dedup, "possible", lambda *a: sent.append(possible(*a)) or sent[-1])
    cells = spark.createDataFrame([(bytes([i // 256, i % 256]), list(range(i, i + 40))) for i in range(600)], "node binary, cells array<int>")
    pairs = spark.createDataFrame([(bytes([0, 1]), bytes([0, k])) for k in (2, 4, 9)], "a binary, b binary")
    got = {bytes(r["b"])[1] for r in near_dedup.similar(pairs, cells, 0.8).collect()}
    assert got == {2, 4}  # 39, 37 and 32 elements in common, of 41, 43 and 48
    assert len(sent) == 1 and sent[0].count() < 10


def test_only_buckets_of_several_texts_enter_the_join(spark, monkeypatch):
    sent, possible = [], near_dedup.possible
    monkeypatch.setattr(near_dedup, "possible", lambda *a: sent.append(possible(*a)) or sent[-1])
    texts = {i: " ".join(f"w{i}x{j}" for j in range(60)) for i in range(300)}
    texts[1000] = texts[7] + " more"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == {i: 7 if i == 1000 else i for i in texts}
    rows = [s.count() for s in sent if dict(s.dtypes)["key"] == "bigint"]
    assert len(rows) == 1 and 2 <= rows[0] <= 2 * near_dedup.Bands().bands  # of 32 * 301


# -- search -----------------------------------------------------------------------


def test_topk_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(400)]
    rows += [(401, None), (402, [1.0, None, 0.0, 0.0]), (403, [float("nan")] * 4), (404, []), (None, [1.0] * 4), (405, [1.0, 2.0]), (7, [2.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    layout = topk_search.Layout(block_rows=90, query_rows=2, page=8, fan=4)
    got = topk_search.top_k(df, df.where("vec_id % 100 = 0"), layout=layout).collect()
    sound = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and x == x for x in v)]
    for q in (0, 100, 200, 300):
        qv = dict(rows[:400])[q]
        want = sorted((-sum(int(np.floor(1024 * x)) * int(np.floor(1024 * y)) for x, y in zip(qv, v)), i) for i, v in sound if i != q)[:10]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    assert topk_search.top_k(df.limit(0), df.limit(0)).collect() == []


# -- pseudonyms --------------------------------------------------------------------


def test_pseudonyms_keep_formats_and_links(spark):
    text = (
        "mail jo.b9@mail7.example.com ip 233.254.104.120. tel +1 (017) 555-7713 card 4111 1111 1111 1111 or 4111111111111111, "
        "not 4111111111111112; born 1984-02-29 or 29.02.1984, not 31.02.1984; iban DE89 3704 0044 0532 0130 00; ssn 123-45-6789; 999.1.1.1"
    )
    docs = spark.createDataFrame([(1, text), (2, "x " + text)], "doc_id long, text string")
    one, two = [r for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]
    assert two["text"] == "x " + one["text"] and len(one["text"]) >= len(text) - 8
    assert [x["kind"] for x in one["pii"]] == ["email", "ip", "phone", "card", "card", "date", "date", "iban", "ssn"]
    assert all(text[x["start"]] != " " for x in one["pii"])
    for gone in ("jo.b9@mail7", "233.254.104.120", "555-7713", "4111 1111 1111 1111", "4111111111111111,", "1984-02-29", "3704 0044", "123-45-6789"):
        assert gone not in one["text"]
    for stays in ("4111111111111112", "31.02.1984", "999.1.1.1", ".com ", "tel +1 ("):
        assert stays in one["text"]
    cards = re.search(r"card ([\d ]{19}) or (\d{16})", one["text"])
    assert cards[1].replace(" ", "") == cards[2]
    total = sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(cards[2]))))
    assert total % 10 == 0
    iso, german = re.search(r"born (\S+) or ([\d.]+),", one["text"]).groups()
    assert iso.split("-") == german.split(".")[::-1]
    iban = re.search(r"iban ([A-Z0-9 ]+);", one["text"])[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_permutations_are_one_to_one(spark):
    df = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"), "id")
    out = df.select(pii.permute_text(F.col("v"), F.lit("k"), (pii.DIGITS,)).alias("p"), pii.permute_pair(F.floor(F.col("id") / 100), F.col("id") % 100, (100, 100), F.lit("k")).alias("q"))
    assert out.select("p").distinct().count() == 10_000 and out.select("q").distinct().count() == 10_000
    assert out.where("length(p) <> 4 or q.a not between 0 and 99 or q.b not between 0 and 99").count() == 0


def test_planted_values_are_gone(spark):
    before = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    form = r"\S+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}"
    found = {m for r in before.collect() for m in re.findall(form, r["text"])}
    after = "\n".join(r["text"] for r in pii.replace_in(before, PII_KEY).collect())
    assert found and not [m for m in found if m in after]


# -- packing ------------------------------------------------------------------------


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = QUERIES["op8_best_fit_packing"](spark, SF_DIR).toPandas()
    for doc, pieces in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array(tok.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        assert pieces.length.sum() == len(ids)
        for p in pieces.itertuples():
            part = ids[p.start : p.start + p.length]
            assert p.start == p.piece * 2048 and p.ids_crc32 == zlib.crc32(part.tobytes())
    assert set(rows.doc_id) == set(texts)
    rows = rows.sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id").length.cumsum()
    assert (rows.offset == ends - rows.length).all() and ends.max() <= 2048
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 2048) * 1.05 + 1


def test_chunked_ids_equal_the_tokenizer():
    import random

    from tokenizers import Tokenizer

    tok, encode, rng = Tokenizer.from_file(tokenizer_path()), packing.encoder(tokenizer_path()), random.Random(3)
    letters = "aAbéΣσς'’.,;!?|<>_-12 \n\t\u0301İßﬁ日"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25))) + rng.choice(["", "<|endoftext|>", "<|ENDOFTEXT|>"])
        assert encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# -- URLs, classifiers, scores ---------------------------------------------------------


def test_urls_without_host_and_false_positives(spark, monkeypatch):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.com/en/x"), (3, "HTTP://WWW.Example.com/en/x"), (4, "http://a.net/es"), (5, "x://a.net/es/1?q#f"), (6, "http://b.org/p/?utm_source=z"), (None, "http://c.org")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("b.org/p",), (None,)], "key string")
    want = {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (4, "a.net", "/es", None, "allow"), (5, "a.net", "/es/1", "net/es/", "block"), (6, "b.org", "/p/", None, "block"), (None, "c.org", "", None, "allow")}
    for blocks in (url_filter.BLOCKS, 1):  # one block: nearly every key passes the filter, the join decides
        monkeypatch.setattr(url_filter, "BLOCKS", blocks)
        got = url_filter.judge(pages, RULES, listed).collect()
        assert len(got) == len(rows) and {tuple(r)[:5] for r in got} == want
    assert url_filter.judge(pages.limit(0), RULES, listed.limit(0)).collect() == []


def test_toxicity_on_held_out_rows_and_misspellings(spark):
    rng = np.random.default_rng(5)
    plain, bad = [f"w{a}{b}en" for a in "abcdefgh" for b in "klmnop"], ["dreadfulness", "horribleword"]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(plain, 40))
        if i % 3 == 0:
            words[rng.integers(40)] = bad[i % 2] + rng.choice(["", "s", "ly"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, marks, toxicity.Subwords(buckets=1 << 14, epochs=20)).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == (held.doc_id % 3 == 0)).mean() > 0.95 and got.score.between(0, 1).all()


def test_topk_of_many_queries_takes_few_products(monkeypatch):
    rng = np.random.default_rng(4)
    vectors = np.floor(1024 * rng.normal(0, 0.125, (3000, 16))).astype(np.int64)
    vectors[1000:1040] = vectors[5]  # ties, one leaf's worth and more
    ids = rng.permutation(3000)
    for factor in (1, 2**36):  # with the larger one products are beyond a double
        tree = topk_search.MTree(ids, vectors * factor, topk_search.Layout(page=32, fan=8))
        pages, read = tree.pages, []
        tree.pages = type("Seen", (list,), {"__getitem__": lambda self, i: read.append(i) or pages[i]})(pages)
        for held in (1 << 20, 50):
            monkeypatch.setattr(topk_search, "HELD", held)
            who, found, scores = tree.search(vectors[:300], ids[:300], 10)
            every = (vectors[:300] @ vectors.T) * factor
            every[np.arange(300), np.arange(300)] = -(2**63) + 1
            for q in range(300):
                order = np.lexsort((ids, -every[q]))[:10]
                assert found[who == q].tolist() == ids[order].tolist() and scores[who == q].tolist() == every[q][order].tolist()
        assert len(read) < 2 * 300 * len(pages) / 10  # of two runs; each query alone read most pages
        monkeypatch.setattr(topk_search, "BOUNDS", 70 * len(pages))
        assert all((a == b).all() for a, b in zip(tree.search(vectors[:300], ids[:300], 10), (who, found, scores)))


def test_weak_labels_find_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_model.score(docs).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.5


def test_lm_prefers_order_it_has_seen(spark):
    rng = np.random.default_rng(6)
    cycle = [f"t{i}" for i in range(20)]
    rows = [(i, " ".join(cycle[(s + k) % 20] for k in range(60))) for i, s in enumerate(rng.integers(20, size=400))]
    rows += [(1000 + i, " ".join(rng.permutation(cycle * 3))) for i in range(20)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), lm_score.Network(mask=2, rounds=3, batch=32)).toPandas()
    good, bad = got[got.doc_id < 1000].mean_log_prob, got[got.doc_id >= 1000].mean_log_prob
    assert good.mean() > bad.mean() + 1 and (got.log_likelihood < 0).all()


def lm_corpus():
    """Texts of far more words than the network has classes, some of them rare, and one of gibberish."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{int(k)}" for k in np.minimum(rng.zipf(1.2, 150), 5000))) for i in range(300)]
    return rows + [(1000, " ".join(f"zq{i}x" for i in range(150))), (1001, "Kein w1\u00a0w2 w1"), (1001, "Kein w1\u00a0w2 w1"), (None, "w7")]


def test_lm_equals_brute_force_with_production_parameters(spark):
    net, rows = lm_score.Network(), lm_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_score.score(docs).toPandas()
    texts = [re.findall("[^\x20\x09-\x0d]+", t.lower()) for _, t in rows]
    n = collections.Counter(w for t in texts for w in t)
    own = {w: i for i, w in enumerate(sorted(n, key=lambda w: (-n[w], w))[: net.frequent])}
    cls = {w: own.get(w, net.frequent + zlib.crc32(w.encode()) % net.hashed) for w in n}
    members = collections.defaultdict(list)
    for w in n:
        members[cls[w]].append(w)
    assert len(n) > 4 * net.words

    def share(w):
        rare = [v for v in members[cls[w]] if n[v] < net.least]
        whole = sum(n[v] for v in members[cls[w]]) + net.add * (len(members[cls[w]]) - len(rare) + 1)
        return 1.0 if w in own else (n[w] + net.add if n[w] >= net.least else (sum(n[v] for v in rare) + net.add) / (len(rare) + 1)) / whole

    lower = docs.select("doc_id", F.lower("text").alias("text")).withColumn("row", F.monotonically_increasing_id())
    embed, out, bias = net.split(lm_score.train(lower, {w.encode(): i for w, i in own.items()}, net, sum(n.values())))
    want = []
    for (i, _), t in zip(rows, texts):
        x = [net.words] * net.side + [cls[w] for w in t] + [net.words] * net.side
        total = 0.0
        for at, w in enumerate(t):
            h = np.tanh(sum(embed[k][x[at + net.side + p]] for k, p in enumerate(net.places)).astype(float))
            z = h @ out + bias
            total += z[cls[w]] - np.log(np.exp(z).sum()) + np.log(share(w))
        want.append((-1 if i is None else i, len(t), total))
    have = sorted((-1 if np.isnan(i) else int(i), k, x) for i, k, x in zip(got.doc_id.astype(float), got.n_words, got.log_likelihood))
    assert [r[:2] for r in have] == [r[:2] for r in sorted(want)]
    assert np.allclose([r[2] for r in have], [r[2] for r in sorted(want)], rtol=1e-3)
    mean = got.set_index("doc_id").mean_log_prob
    assert mean[1000.0] < mean[mean.index < 300].min() - 1  # gibberish, whose words fall into the same classes


def test_lm_training_predicts_every_word_whatever_the_layout(spark):
    net = lm_score.Network()
    for n in (1, 2, 7, 150):
        assert sorted(np.concatenate([lm_score.masked(n, turn, net) for turn in range(net.rounds)])) == list(range(n))
    docs = spark.createDataFrame(lm_corpus(), "doc_id long, text string")
    one, many = ({r["doc_id"]: r["log_likelihood"] for r in lm_score.score(docs.repartition(k)).collect()} for k in (1, 13))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) < 1e-3 * abs(one[i]) for i in one)


def test_lm_keeps_classes_instead_of_texts_and_joins_only_words_not_listed(spark, monkeypatch):
    docs = spark.createDataFrame(lm_corpus(), "doc_id long, text string")
    written, saved = [], lm_score.saved
    monkeypatch.setattr(lm_score, "saved", lambda df: written.append(saved(df)) or written[-1])
    scores = []
    for listed in (lm_score.LISTED, 40, 0):
        monkeypatch.setattr(lm_score, "LISTED", listed)
        scores.append(sorted((r["doc_id"] or -1, r["log_likelihood"]) for r in lm_score.score(docs).collect()))
    assert not any("text" in df.columns for df in written)
    left = [sum(len(r["others"].split()) for r in df.collect()) for df in written if "others" in df.columns]
    n = collections.Counter(w for _, t in lm_corpus() for w in re.findall("[^\x20\x09-\x0d]+", t.lower()))
    assert left[0] == sum(k for k in n.values() if k < lm_score.Network().least) < left[1] < left[2]
    for other in scores[1:]:
        assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 * abs(a[1]) + 1e-9 for a, b in zip(scores[0], other))


def test_lm_small_part_steps_per_batch():
    net, ids = lm_score.Network(), lm_score.WordIds({b"a": 0, b"b": 1}, lm_score.Network())
    flat = net.start()
    for turn in range(net.rounds):
        flat, seen = lm_score.train_part(iter(["a b " * 2000]), flat, ids, net, turn)
    x = lm_score.padded_ids("a b " * 50, ids, net)
    assert seen == 4000 and lm_score.log_probabilities(x, net.split(flat), net) / 100 > -2  # at the start -5.5, with one step a round -3.5


def test_lm_short_texts_go_through_the_network_together(monkeypatch):
    net, rng = lm_score.Network(), np.random.default_rng(4)
    texts = [lm_score.padded(rng.integers(0, net.words, n), net) for n in [0, 1, 0, *rng.integers(0, 30, 400), 700, 0]]
    embed, out, bias = parts = net.split(rng.normal(0, 0.3, net.size).astype(np.float32))
    passes, hidden_of = [], lm_score.hidden_of
    monkeypatch.setattr(lm_score, "hidden_of", lambda *a: passes.append(1) or hidden_of(*a))
    got = lm_score.sums(iter(texts), parts, net)
    assert len(passes) < len(texts) / 10 and len(lm_score.sums([], parts, net)) == 0
    for x, have in zip(texts, got, strict=True):
        n = len(x) - 2 * net.side
        z = np.tanh(sum(embed[i][x[net.side + p : net.side + p + n]] for i, p in enumerate(net.places)).astype(float)) @ out + bias
        assert np.isclose(have, sum(z[i, c] - np.log(np.exp(z[i]).sum()) for i, c in enumerate(x[net.side : net.side + n])), rtol=1e-4)


def test_lm_copies_are_averaged_by_words(spark):
    net = lm_score.Network(frequent=5, hashed=4, hidden=3, copy_words=9000)
    docs = spark.createDataFrame(lm_corpus(), "doc_id long, text string").select("doc_id", F.lower("text").alias("text"))
    codes = lm_score.coded(docs, {f"w{i}".encode(): i - 1 for i in range(1, 6)}, {}, net)
    n_words = codes.agg(F.sum("n_words")).first()[0]
    got = lm_score.train_coded(codes, net, n_words)
    dealt = codes.repartition(-(-n_words // net.copy_words), "deal").sortWithinPartitions("deal", "doc_id", "classes")
    copies = dealt.select("classes", F.spark_partition_id().alias("p")).toPandas().groupby("p").classes.apply(list)
    assert len(copies) > 2 and net.size % lm_score.WIDE
    want = net.start()
    for turn in range(net.rounds):
        each = [lm_score.train_padded((lm_score.padded(np.frombuffer(c, np.uint8), net) for c in own), want, net, turn) for own in copies]
        want = sum(flat.astype(float) * seen for flat, seen in each) / n_words
        want = want.astype(np.float32)
    assert got.shape == want.shape and np.allclose(got, want, atol=1e-4)


def test_toxicity_keeps_the_prior_where_the_bound_holds(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same plain words in every text").alias("text"))
    marks = docs.select("doc_id", (F.col("doc_id") % 20 == 0).cast("int").alias("toxic"))
    got = toxicity.score(docs, marks, toxicity.Subwords(buckets=1 << 12, per_class=100, epochs=60)).toPandas()
    assert abs(got.score.mean() - 0.05) < 0.03 and not got.predicted.any()


def test_both_of_doubled_marks_count(spark):
    lines = {"Buy this thing now!!": True, "Buy this thing now!": False, "Is this the very thing??": True, "Is it ?!!? now, after all of this.": True,
             "Such a line is long enough to shout now!!": False}
    df = spark.createDataFrame([(x,) for x in lines], "line string").select("line", quality_rules.line_fails(F.col("line"), quality_rules.Rules()).alias("f"))
    assert {r["line"]: r["f"] for r in df.collect()} == lines


def test_pii_iban_lengths_phone_groups_and_american_dates(spark):
    cases = {
        "ES91 2100 0418 4502 0005 1332 BIC": "iban", "BE68 5390 0754 7034 EUR": "iban", "AT61 1904 3002 3457 3201 2024": "iban", "NO93 8601 1117 947": "iban",
        "GB29NWBK60161331926819": "iban", "+14155550123": "phone", "+49 30 1234567": "phone", "+44 20 7946 0958": "phone", "+33 1 42 68 53 00": "phone",
        "+44 (0)20 7946 0958": "phone", "12/31/2020": "date", "31/12/2020": "date",
    }
    for c in (*cases, "+1415", "13/31/2020", "+1415555012345678"):
        cases.setdefault(c, None)
    got = pii.pseudonymise(spark.createDataFrame([(c, f"see {c}, or") for c in cases], "value string, text string"), "k").collect()
    for r in got:
        assert [x["kind"] for x in r["pii"]] == ([cases[r["value"]]] if cases[r["value"]] else []), r
        assert (r["value"] in r["text"]) == (cases[r["value"]] is None) and len(r["text"]) == len(f"see {r['value']}, or")
    text = {r["value"]: r["text"][4:-4] for r in got}
    assert text["ES91 2100 0418 4502 0005 1332 BIC"].endswith(" BIC") and text["AT61 1904 3002 3457 3201 2024"].endswith(" 2024")
    assert text["+14155550123"][:2] == "+1" and text["+49 30 1234567"][:4] == "+49 "
    month, day, _ = map(int, text["12/31/2020"].split("/"))
    assert 1 <= month <= 12 and 1 <= day <= 31


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = quality_rules.keep_clean(docs)
    assert clean.columns == docs.columns
    verdicts = {r["doc_id"]: r["rules"]["kept"] for r in quality_rules.judge_lines(docs).select("doc_id", "rules").collect()}
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {i for i, k in verdicts.items() if k}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, clean, SF_DIR).columns == docs.columns, name
    out = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert len(out) and set(out.doc_id) <= {i for i, k in verdicts.items() if k}
    assert out.groupby("sequence_id").length.sum().max() <= 2048
