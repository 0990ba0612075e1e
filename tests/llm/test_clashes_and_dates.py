"""Columns that bear an operator's own names, and dates at both ends of the calendar."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafwave.llm import mixing, near_dedup, pii, quality_rules

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("mix", "Rules", "pii", "__own", "c0", "c1", "__nd_node", "__nd_id", "__nd_text", "__mix_source", "__mix_stats", "__mix_copy", "__mix_verdict", "__qr_w", "__qr_verdict", "__pii_m", "__pii_found", "copies", "label", "node", "f", "a.b")


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "a", 0), (9001, "", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(odd)


def clashing(df):
    return df.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES])


def rows(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES[:4]])
def test_stages_carry_clashing_columns(spark, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    plain, odd = run(spark, docs, SF_DIR), run(spark, clashing(docs), SF_DIR)
    assert odd.columns == [*docs.columns, *NAMES]
    assert rows(plain, *docs.columns) == rows(odd, *docs.columns)
    for r in odd.select("doc_id", "mix", "`a.b`", "__own").collect():
        who = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert (r["mix"], r["a.b"], r["__own"]) == (f"mix:{who}", f"a.b:{who}", f"__own:{who}")


def test_results_stand_in_place_of_columns_of_their_name(docs):
    for out, name in ((mixing.mix(clashing(docs)), "mix"), (quality_rules.judge_lines(clashing(docs)), "rules"), (pii.pseudonymise(clashing(docs), "k"), "pii")):
        assert out.columns == [*[c for c in clashing(docs).columns if c.lower() != name], name]
        assert out.count() == docs.count()
    assert near_dedup.keep_first(clashing(docs).limit(0)).collect() == []


def test_dates_keep_to_the_calendar_one_to_one(spark):
    """Every day of the first and of the last 400-year cycle."""
    for first, last in (("0001-01-01", "0399-12-31"), ("9600-01-01", "9999-12-31")):
        days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS d").repartition(8)
        text = F.concat_ws("-", *[F.lpad(f("d").cast("string"), n, "0") for f, n in ((F.year, 4), (F.month, 2), (F.day, 2))])
        out = pii.pseudonymise(days.select(text.alias("text")), "k").select("text")
        seen = out.agg(F.count("*").alias("n"), F.count_distinct("text").alias("m"), F.min("text").alias("lo"), F.max("text").alias("hi")).first()
        assert seen["n"] == seen["m"] == days.count() and first <= seen["lo"] and seen["hi"] <= last
        assert out.where(~F.col("text").rlike(r"^\d{4}-\d\d-\d\d$") | F.col("text").try_cast("date").isNull()).count() == 0


@pytest.mark.parametrize("year", [1, 199, 9800, 9999])
def test_dates_of_odd_years_stay_linked(spark, year):
    forms = [f"{year:04d}-12-31", f"31.12.{year:04d}", f"12/31/{year:04d}"]
    (r,) = pii.pseudonymise(spark.createDataFrame([(", ".join(["on " + f for f in forms]),)], "text string"), "k").collect()
    iso, german, american = re.findall(r"on ([^,]+)", r["text"])
    y, m, d = iso.split("-")
    assert [x["kind"] for x in r["pii"]] == ["date"] * 3 and iso != forms[0] and german == f"{d}.{m}.{y}" and 1 <= int(y) <= 9999
    assert american.split("/") == [m, d, y]
