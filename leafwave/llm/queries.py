"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.llm import bpe, clustering, filter_audit, lm_score, mixing, near_dedup, packing, pii, quality_model, quality_rules, topk_search, toxicity, url_filter
from leafwave.llm.common import read
from leafwave.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PII_KEY = "leafwave-pseudonyms-1"
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A host with one of these labels has its pages on the list of canonical URLs.
LISTED_LABELS = ("cheap-pills", "spam-farm", "casino-win", "ads-track", "free-bets", "adult-x")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _list(marks: str) -> str:
    return ", ".join("'" + m.replace("'", "''") + "'" for m in marks)


# -- 1 ------------------------------------------------------------------------


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# -- 2 ------------------------------------------------------------------------

MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT
      / {16**12}::DOUBLE AS draw
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight FROM per),
-- Fill source after source in the order of size by weight; the level at the first that is not full holds for the rest.
steps AS (SELECT *,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0) AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS weight_left
  FROM weighed
  WINDOW f AS (ORDER BY source_size / weight::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_max(CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE), weight_left) AS height FROM steps
  WHERE 3 * source_size * weight_left > weight * words_left),
targets AS (SELECT source, source_size,
    CASE WHEN 3 * source_size * weight_left <= weight * words_left THEN 3.0::DOUBLE * source_size ELSE weight::DOUBLE * height END AS target
  FROM steps CROSS JOIN level),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate FROM targets)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source"""


@query("op2_source_mix", MIX_SQL)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("mix")
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * m["copies"]).cast("long").alias("taken"),
    )


# -- 3 ------------------------------------------------------------------------


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf_dir, "documents"))


# -- 4 ------------------------------------------------------------------------

TOPK_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(1024.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query("op4_exact_topk", TOPK_SQL)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(100)) == 0))


# -- 5 ------------------------------------------------------------------------


@query("op5_pii_pseudonyms")
def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(read(spark, sf_dir, "documents"), PII_KEY)
    of_kind = F.transform("pii", lambda x: x["kind"])
    counts = [(F.size(of_kind) - F.size(F.array_remove(of_kind, k))).alias(f"n_{k}") for k in pii.KINDS]
    return out.select("doc_id", "text", F.size("pii").alias("n_found"), *counts)


# -- 6 ------------------------------------------------------------------------


@query("op6_quality_model")
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(read(spark, sf_dir, "documents"))


# -- 7 ------------------------------------------------------------------------

_R = quality_rules.Rules()
_LINE_WORDS = "len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))"
_SOLID = "length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))"


def _marks(column: str, marks: str) -> str:
    return f"(length({column}) - length(translate({column}, '{marks.replace(chr(39), chr(39) * 2)}', '')))"


RULES_SQL = f"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS lines
  FROM documents),
windows AS (
  SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g,
    list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS worded,
    list_filter(lines, lambda x: NOT ({_SOLID} > 0 AND (
        {_marks("x", quality_rules.ODD_MARKS)} + (length(x) - length(replace(replace(x, '!!', ''), '??', ''))) > {_R.max_marks} * {_SOLID}
        OR (NOT contains('{quality_rules.CLOSING_MARKS.replace("'", "''")}', right(rtrim(regexp_replace(x, '[\\x09-\\x0D]', ' ', 'g'), ' '), 1)) AND {_LINE_WORDS} < {_R.min_open_words})
        OR ({_marks("x", quality_rules.SEPARATORS)} >= 2 AND {_marks("x", quality_rules.SEPARATORS)} * {_R.words_per_separator} >= {_LINE_WORDS})
        OR (({" OR ".join(f"contains(lower(x), '{b}')" for b in quality_rules.BOILERPLATE)}) AND {_LINE_WORDS} <= {_R.max_boilerplate_words})))) AS remaining
  FROM parts),
-- Words covered by a window that its text holds twice, per text that has one.
placed AS (SELECT row, unnest(g) AS g, unnest(range(len(g))) AS i FROM (SELECT row_number() OVER () AS row, * FROM windows)),
again AS (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM placed),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM again, range(3) r(k) WHERE again.n > 1 GROUP BY row),
counted AS (
  SELECT windows.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST({_marks("t", quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols, CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(array_to_string(remaining, chr(10)), '[^\\x20\\x09-\\x0D]+')) AS kept_words
  FROM (SELECT row_number() OVER () AS row, * FROM windows) windows LEFT JOIN covered USING (row)),
judged AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND kept_words >= n_words * {1.0 - _R.max_lost!r}::DOUBLE AS kept
FROM judged"""


@query("op7_quality_rules", RULES_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("rules")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.judge_lines(read(spark, sf_dir, "documents")).select("doc_id", *[r[n].alias(n) for n in names])


# -- 8 ------------------------------------------------------------------------


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


# -- 9 ------------------------------------------------------------------------


def _split_sql(u: str) -> str:
    rest = f"(CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END)"
    host = f"regexp_extract({rest}, '^[^/?#]*')"
    return f"translate({host}, '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, regexp_extract(substr({rest}, length({host}) + 1), '^[^?#]*') AS path"


URL_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, page_id, {_split_sql("coalesce(url, '')")},
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^{url_filter.TRACKING}(=|$)'))) AS kept
  FROM pages),
own AS (SELECT *, host || regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM split),
listed AS (SELECT DISTINCT canonical FROM own
  WHERE host <> '' AND list_has_any(string_split(host, '.'), [{", ".join(f"'{x}'" for x in LISTED_LABELS)}])),
rules(verdict, rule_host, rule_path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
fitting AS (
  SELECT row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM own JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(fitting.verdict, CASE WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  listed.canonical IS NOT NULL AS listed
FROM own LEFT JOIN fitting USING (row) LEFT JOIN listed ON own.canonical = listed.canonical AND own.host <> ''"""


@query("op9_url_filter", URL_SQL)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    host, _ = url_filter.host_and_path(F.col("url"))
    bad = F.arrays_overlap(F.split(host, "\\."), F.array(*[F.lit(x) for x in LISTED_LABELS]))
    listed = pages.where((host != "") & bad).select(url_filter.canonical(F.col("url")).alias("key"))
    return url_filter.judge(pages, RULES, listed)


# -- 10 -----------------------------------------------------------------------


@query("op10_lm_score")
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


# -- 11 -----------------------------------------------------------------------


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# -- 12 -----------------------------------------------------------------------

_LETTERS = "(VALUES " + ", ".join(f"('{x}')" for x in filter_audit.FILTERS) + ")"
AUDIT_SQL = f"""
WITH parts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
failing AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < {filter_audit.MIN_WORDS} THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {filter_audit.MAX_CAPITAL_PERCENT} * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '{filter_audit.MARKS}') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM parts),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM {_LETTERS} a(x), {_LETTERS} b(x), {_LETTERS} c(x), {_LETTERS} d(x), {_LETTERS} e(x)
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, CAST(k AS INT) AS step, substr(filter_order, k, 1) AS own, substr(filter_order, 1, k - 1) AS before
  FROM orders, range(1, 6) r(k)),
met AS (
  SELECT *, length(translate(fails, before, '')) = length(fails) AS reached, contains(fails, own) AS caught FROM steps, counted),
summed AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (reached AND NOT caught), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (reached AND caught), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (NOT reached AND caught), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (reached AND caught), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (reached AND caught), 0) AS BIGINT) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM summed"""


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# -- 13 -----------------------------------------------------------------------

CLUSTERS, DIMS, ROUNDS, START = 8, 64, 10, "3:"


def _rounds_sql() -> str:
    """Each round as two tables: every vector's nearest centroid, and the centroids after it."""
    gap = "CAST(list_sum(list_transform(list_zip(v.v, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    out = []
    for r in range(ROUNDS + 1):
        out.append(f"a{r} AS MATERIALIZED (SELECT row, min({{'d': {gap}, 'c': c.c}}) AS best FROM v, c{r} c GROUP BY row)")
        if r < ROUNDS:
            out.append(
                f"s{r} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.best.c AS c, unnest(v.v) AS x, unnest(range({DIMS})) AS i FROM v JOIN a{r} a USING (row)) GROUP BY c, i), "
                f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(g.m, o.m) AS m FROM c{r} o LEFT JOIN "
                f"(SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{r} GROUP BY c) g USING (c))"
            )
    return ", ".join(out)


KMEANS_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(nth - 1 AS INT) AS c, v AS m FROM (SELECT v, row_number() OVER (ORDER BY sha256('{START}' || vec_id)) AS nth FROM v WHERE vec_id IS NOT NULL)
  WHERE nth <= {CLUSTERS}),
{_rounds_sql()}
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.m, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} USING (row) JOIN c{ROUNDS} c ON c.c = best.c"""


@query("op13_centroid_clusters", KMEANS_SQL)
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clustering.cluster(read(spark, sf_dir, "embeddings"), CLUSTERS, DIMS, ROUNDS, START)
    hashed = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", hashed.alias("centroid_sha256"))
