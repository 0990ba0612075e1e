"""Line-first cleaning: rules judge single lines, then the document by what is left.

A line fails when it has a word and one of these holds:

* punctuation: marks that prose hardly uses, and doubled exclamation or question
  marks (both of a pair count), make up more than ``max_marks`` of its characters that are not spaces,
  or it ends without a closing mark and has fewer than ``min_open_words`` words;
* navigation: it has at least two menu separators and one for every
  ``words_per_separator`` words or fewer;
* boilerplate: it holds a phrase of page furniture and at most
  ``max_boilerplate_words`` words.

Failed lines are removed. A document is kept when the removed lines held at
most ``max_lost`` of its words and it passes the base rules (enough words, not
mostly repeated three-word windows).

Everything is a row-wise expression: no shuffle, no Python, the rows of every
partition stand alone. Repeated windows are found by sorting a document's own
windows, so a long text costs n log n.

Null text counts as no words: all counts 0, base failed, not kept, cleaned
text null. Empty text likewise, with cleaned text empty. Repeated rows are
judged each on its own; an empty table gives an empty table. Columns other
than the text are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.columns import packed
from leafwave.llm.common import SPACE, SPACES, WORD, once, words

# -- fixed values ------------------------------------------------------------
SYMBOLS = "#*$%&|<>"
ODD_MARKS = "#*$%&|<>{}[]\\^~_=+@"
SEPARATORS = "|»›·•→"
CLOSING_MARKS = ".!?:;…\"'”’»)"
BOILERPLATE = (
    "all rights reserved",
    "cookie",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "subscribe to",
    "sign up for",
    "click here",
    "read more",
    "back to top",
    "skip to content",
    "licensed under",
    "lorem ipsum",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_marks: float = 0.08
    min_open_words: int = 5
    words_per_separator: int = 5
    max_boilerplate_words: int = 40
    max_lost: float = 0.3


def _any_of(characters: str) -> str:
    """A character class, written alike for Java and RE2."""
    return "[" + "".join("\\" + c if c in "\\[]^-&" else c for c in characters) + "]"


def _stage(df: DataFrame, **columns: Column) -> DataFrame:
    """One projection per step: what a step makes is computed once per row, also where lambdas use it."""
    return df.withColumns(columns)


def line_fails(line: Column, r: Rules) -> Column:
    """Whether one line breaks a rule; false for a line without a word. Cheap tests come first."""
    solid = F.char_length(line) - F.regexp_count(line, F.lit(SPACE))
    n = F.regexp_count(line, F.lit(WORD))
    doubled = F.char_length(line) - F.char_length(F.replace(F.replace(line, F.lit("!!"), F.lit("")), F.lit("??"), F.lit("")))
    marks = F.regexp_count(line, F.lit(_any_of(ODD_MARKS))) + doubled
    closed = F.lit(CLOSING_MARKS).contains(F.right(F.rtrim(line, F.lit(SPACES)), F.lit(1)))
    separators = F.regexp_count(line, F.lit(_any_of(SEPARATORS)))
    furniture = reduce(lambda a, b: a | b, [F.lower(line).contains(phrase) for phrase in BOILERPLATE])
    return line.rlike(WORD) & (
        (~closed & (n < r.min_open_words))
        | (marks > solid * F.lit(r.max_marks))
        | ((separators >= 2) & (separators * r.words_per_separator >= n))
        | ((n <= r.max_boilerplate_words) & furniture)
    )


def judge_lines(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with one more column, the struct ``rules``: counts, verdicts and the cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_failed_lines, kept_words, base_failed, kept, clean_text.
    """
    docs, back = packed(docs, (text,))
    t = F.col(f"`{text}`")
    safe = F.coalesce(t, F.lit(""))
    w, lines, windows, placed = (F.col(f"__qr_{x}") for x in ("w", "lines", "windows", "placed"))
    worded, left, starts, clean = (F.col(f"__qr_{x}") for x in ("worded", "left", "starts", "clean"))
    staged = _stage(docs, __qr_w=words(t), __qr_lines=F.coalesce(F.split(t, "\n"), F.array().cast("array<string>")))
    full = F.greatest(F.size(w) - 2, F.lit(0))
    staged = _stage(
        staged,
        __qr_windows=F.transform(
            F.slice(w, F.lit(1), full), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))
        ),
        __qr_worded=F.filter(lines, lambda x: x.rlike(WORD)),
        __qr_left=F.filter(lines, lambda x: ~line_fails(x, rules)),
    )
    # Windows sorted with their places; equal ones are then neighbours. Empty where all differ.
    none = F.array().cast("array<struct<w:string,i:int>>")
    staged = _stage(
        staged,
        __qr_placed=F.when(F.size(F.array_distinct(windows)) == F.size(windows), none).otherwise(
            F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        ),
        __qr_clean=F.when(t.isNotNull(), F.array_join(left, "\n")),
    )
    staged = _stage(
        staged,
        __qr_starts=F.transform(
            F.filter(
                placed,
                lambda x, i: F.coalesce(F.get(placed, i - 1)["w"] == x["w"], F.lit(False))
                | F.coalesce(F.get(placed, i + 1)["w"] == x["w"], F.lit(False)),
            ),
            lambda x: x["i"],
        ),
        __qr_kept=F.when(F.size(left) == F.size(lines), F.size(w)).otherwise(F.coalesce(F.regexp_count(clean, F.lit(WORD)), F.lit(0))),
    )
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    n, rep, kept_words = (F.col(f"__qr_{x}") for x in ("n", "rep", "kept"))
    staged = _stage(staged, __qr_n=F.size(w).cast("long"), __qr_rep=F.size(covered).cast("long"))
    base_failed = (n < rules.min_words) | (rep * 100 > n * rules.max_repeat_percent)
    enough = kept_words >= n * F.lit(1.0 - rules.max_lost)
    verdict = F.struct(
        n.alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(safe, F.lit(_any_of(SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
        rep.alias("n_repeat_words"),
        (F.size(lines) - F.size(left)).cast("long").alias("n_failed_lines"),
        kept_words.cast("long").alias("kept_words"),
        base_failed.alias("base_failed"),
        (~base_failed & enough).alias("kept"),
        clean.alias("clean_text"),
    )
    # A filter on the verdict must not be pushed down: the steps would be worked out again inside each other.
    judged = staged.select(*[F.col(f"`{c}`") for c in docs.columns], once(verdict).alias("__qr_verdict"))
    return judged.select(*back("rules"), F.col("__qr_verdict").alias("rules"))


def keep_clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Documents that pass, with their failed lines gone and ``n_chars`` counted again.

    Documents that lose no line keep their text as it is.
    """
    docs, back = packed(docs, ("text", "n_chars"))
    out = judge_lines(docs, rules=rules).where("rules.kept")
    changes = {"text": F.col("rules.clean_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        lost = F.col("rules.n_failed_lines") > 0
        changes["n_chars"] = F.when(lost, F.char_length("rules.clean_text").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(changes).select(*back())
