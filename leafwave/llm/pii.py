"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

A text is cut at its candidates (one pattern finds them all); each candidate is
validated and, if it holds, replaced by the permutation of its value within its
own format. The same value gives the same pseudonym in every document and
partition, so records stay linked; without the key it cannot be undone.

=========  ===================================  ======================================
kind       valid when                           permuted
=========  ===================================  ======================================
email      address form, at most 64 + 254       letters and digits within their
           characters                           alphabets, all but the last label
iban       as long as its country has it,       account letters and digits; check
           mod-97 check holds                   digits made anew
secret     32 to 64 hex digits of one case,     hex digits and hex letters
           with a digit and a letter
date       a day of the calendar, written       the day within its 400-year cycle
           y-m-d, d.m.y, d/m/y, or m/d/y
           where d/m/y is no day
ip         four octets up to 255                the 32-bit value as two halves
phone      country code and area code in        digits after the country code
           brackets, or three groups; or +,
           country code and 7 to 15 digits
ssn        no zero group, area below 900, not   all nine digits
           666
card       13 to 19 digits, alone or in card    all digits but the last; check digit
           groups, Luhn sum holds               made anew
=========  ===================================  ======================================

Digits are permuted without their separators and put back between them, so a
number written with and without spaces keeps one pseudonym. What fails its
check stays as it is. Text length never changes, but for dates and IP
addresses, whose parts may get another number of digits (IP only).

Everything is a row-wise expression: no shuffle, no Python. Null text stays
null with no findings; empty text stays empty. Repeated rows get equal results,
an empty table gives an empty table, very long texts are read whole. Other
columns are carried along whatever their names; only ``pseudonymise`` leaves out
a column named ``pii``, in whose place the result stands. Phone numbers have no
check digit: their form alone decides. Dates lie in the years 1 to 9999 and stay
there.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.llm.columns import packed

# -- fixed values: candidate forms -------------------------------------------
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,6}"
#: Lengths of the IBANs of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    tail = f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}{tail}"


#: Cut to the country's length if that ends a word; other countries and lengths by form.
IBAN = (
    r"(?<![\p{L}\p{N}])(?=[A-Z]{2}[0-9]{2})(?:(?:"
    + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
    + r")(?![\p{L}\p{N}])|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}]))"
)
SECRET = r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])"
DATE = r"(?<![\p{L}\p{N}.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\p{L}\p{N}])"
IP = r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
PHONE = r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{2,4}\)[ -]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\p{L}\p{N}])"
#: E.164, or any groups after a plus; the last group has two digits or more.
PHONE += (
    r"|(?<![\p{L}\p{N}+])\+[1-9](?:[0-9]{6,14}(?![\p{L}\p{N}])"
    r"|(?:[ ./-]?\(?[0-9]\)?){6,14}(?<=[0-9]{2})(?![\p{L}\p{N}]))"
)
#: Country calling codes of one and two digits; all others have three.
CALLING = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
SSN = r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])"
CARD = (
    r"(?<![\p{L}\p{N}])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5})"
    r"(?![\p{L}\p{N}])"
)
CANDIDATE = "|".join((EMAIL, IBAN, SECRET, DATE, IP, PHONE, SSN, CARD))
KINDS = ("email", "iban", "secret", "date", "ip", "phone", "ssn", "card")

# -- fixed values: alphabets and the calendar --------------------------------
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
LATIN_LOWER = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"
LATIN_UPPER = LATIN_LOWER.upper()
GREEK_LOWER = "αβγδεζηθικλμνξοπρστυφχψω"
CYRILLIC_LOWER = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
LETTERS = (LOWER, UPPER, DIGITS, LATIN_LOWER, LATIN_UPPER, GREEK_LOWER, GREEK_LOWER.upper(), CYRILLIC_LOWER, CYRILLIC_LOWER.upper())
HEX = (DIGITS, "abcdef", "ABCDEF")
ROUNDS = 8
#: Days of 400 Gregorian years, 146097 = 189 * 773: the two halves of a date.
DATE_HALVES = (189, 773)
#: 400-year cycles that end with the year 9999; the first day of the year 1 counted from there.
CYCLE_START = "2000-01-01"
FIRST_DAY = (datetime.date(1, 1, 1) - datetime.date.fromisoformat(CYCLE_START)).days
#: Steps to leave the year 0, each of which fails with a probability of 0.0025.
WALK = 24
IP_HALVES = (65536, 65536)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shift(c: Column, by: Column, alphabets: tuple[str, ...]) -> Column:
    out = None
    for letters in alphabets:
        at = F.instr(F.lit(letters), c)
        moved = F.substring(F.lit(letters), (F.pmod(at - 1 + by, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
        out = F.when(at > 0, moved) if out is None else out.when(at > 0, moved)
    return out.otherwise(c)


def permute_text(value: Column, key: Column, alphabets: tuple[str, ...]) -> Column:
    """Feistel over the characters: places of one parity move by a hash of those of the other, in turns."""

    def one_round(s: Column, r: Column) -> Column:
        still = F.array_join(
            F.transform(F.split(s, ""), lambda c, i: F.when(F.pmod(i + r, F.lit(2)) == 1, c).otherwise(F.lit("_"))), ""
        )
        seed = F.sha2(F.concat_ws("|", key, r.cast("string"), still), 256)
        return _let(
            seed,
            lambda d: F.array_join(
                F.transform(
                    F.split(s, ""),
                    lambda c, i: F.when(F.pmod(i + r, F.lit(2)) == 1, c).otherwise(
                        _shift(c, _number(F.sha2(F.concat(d, i.cast("string")), 256)), alphabets)
                    ),
                ),
                "",
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value, one_round)


def permute_pair(a: Column, b: Column, sizes: tuple[int, int], key: Column) -> Column:
    """Feistel over [0, sizes[0]) x [0, sizes[1]), as a struct (a, b)."""

    def one_round(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        other = F.when(even, s["b"]).otherwise(s["a"])
        move = _number(F.sha2(F.concat_ws("|", key, r.cast("string"), other.cast("string")), 256))
        return F.struct(
            F.when(even, F.pmod(s["a"] + move, F.lit(sizes[0]))).otherwise(s["a"]).cast("long").alias("a"),
            F.when(even, s["b"]).otherwise(F.pmod(s["b"] + move, F.lit(sizes[1]))).cast("long").alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one_round)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _fill(form: Column, pattern: str, characters: Column) -> Column:
    """``form`` with the characters that match ``pattern`` replaced, in order, by those given."""
    return F.array_join(
        F.transform(
            F.split(form, ""),
            lambda c, i: F.when(
                c.rlike(pattern),
                F.substring(characters, F.regexp_count(F.substring(form, F.lit(1), i + 1), F.lit(pattern)), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def luhn_sum(digits: Column) -> Column:
    """Luhn sum with the last digit as the check digit."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(F.pmod(i, F.lit(2)) == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add)


def iban_rest(iban: Column) -> Column:
    """The number that an IBAN without spaces stands for, modulo 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.lit(40)), F.substring(iban, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, F.pmod(rest * 100 + letter + 9, F.lit(97))).otherwise(
            F.pmod(rest * 10 + F.instr(F.lit(DIGITS), c) - 1, F.lit(97))
        )

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda rest, c: add(rest, c).cast("int"))


def _date_parts(m: Column) -> tuple[Column, Column, Column, Column, Column]:
    """Whether y-m-d, whether m/d/y, and the year, month and day."""
    iso = F.substring(m, F.lit(5), F.lit(1)) == "-"
    part = lambda at, n: F.substring(m, F.lit(at), F.lit(n)).cast("int")
    year = F.when(iso, part(1, 4)).otherwise(part(7, 4))
    # With a month up to 12, d/m/y that is no day is none as m/d/y either.
    turned = (F.substring(m, F.lit(3), F.lit(1)) == "/") & (part(4, 2) > 12)
    month = F.when(iso, part(6, 2)).when(turned, part(1, 2)).otherwise(part(4, 2))
    day = F.when(iso, part(9, 2)).when(turned, part(4, 2)).otherwise(part(1, 2))
    return iso, turned, year, month, day


def _kind(m: Column) -> Column:
    """The kind whose form and check the candidate meets; null if none."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    iso, turned, year, month, day = _date_parts(m)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    longest = F.when(month == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28))).when(month.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31))
    octets = F.forall(F.split(m, "\\."), lambda o: o.cast("int") <= 255)
    d = digits_of(m)
    return (
        F.when(m.contains("@"), F.lit("email"))
        .when(whole(IBAN) & F.when(whole(IBAN), iban_rest(F.replace(m, F.lit(" "), F.lit(""))) == 1), F.lit("iban"))
        .when(whole(SECRET) & m.rlike("[0-9]") & m.rlike("[a-fA-F]"), F.lit("secret"))
        .when(whole(DATE), F.when((year >= 1) & month.between(1, 12) & (day >= 1) & (day <= longest), F.lit("date")))
        .when(whole(IP), F.when(octets, F.lit("ip")))
        .when(whole(PHONE), F.lit("phone"))
        .when(whole(SSN), F.when(~d.rlike("^(?:000|666|9)|^...00|0000$"), F.lit("ssn")))
        .when(whole(CARD), F.when(F.pmod(luhn_sum(d), F.lit(10)) == 0, F.lit("card")))
    )


def _pseudonym(kind: Column, m: Column, key: str) -> Column:
    """The candidate's replacement; the candidate itself where ``kind`` is null."""
    salt = F.concat_ws("|", F.lit(key), kind)
    cut = F.regexp_extract(m, r"\.[A-Za-z0-9-]+$", 0)
    email = F.concat(
        permute_text(F.substring(m, F.lit(1), F.char_length(m) - F.char_length(cut)), salt, LETTERS), cut
    )
    plain = F.replace(m, F.lit(" "), F.lit(""))
    account = permute_text(F.substring(plain, F.lit(5), F.lit(40)), salt, (DIGITS, UPPER))
    iban = _let(
        account,
        lambda a: F.concat(
            F.substring(m, F.lit(1), F.lit(2)),
            F.lpad((98 - iban_rest(F.concat(F.substring(m, F.lit(1), F.lit(2)), F.lit("00"), a))).cast("string"), 2, "0"),
            _fill(F.substring(m, F.lit(5), F.lit(60)), "[A-Z0-9]", a),
        ),
    )
    iso, turned, year, month, day = _date_parts(m)
    days = F.datediff(F.make_date(year, month, day), F.lit(CYCLE_START).cast("date")).cast("long")
    cycle = DATE_HALVES[0] * DATE_HALVES[1]

    def turn(n: Column) -> Column:
        within = F.pmod(n, F.lit(cycle))
        pair = permute_pair(F.floor(within / DATE_HALVES[1]), F.pmod(within, F.lit(DATE_HALVES[1])), DATE_HALVES, salt)
        return _let(pair, lambda p: n - within + p["a"] * DATE_HALVES[1] + p["b"])

    # A day of the year 0 is no date: permute on until the day is one, which keeps the mapping one to one.
    walked = lambda n: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), n, lambda x, _: F.when(x < FIRST_DAY, turn(x)).otherwise(x))
    moved = _let(_let(days, turn), lambda n: F.when(n >= FIRST_DAY, n).otherwise(walked(n)))
    date = F.date_add(F.lit(CYCLE_START).cast("date"), moved.cast("int"))
    y, mo, dd = (F.lpad(f(date).cast("string"), n, "0") for f, n in ((F.year, 4), (F.month, 2), (F.day, 2)))
    sep = F.substring(m, F.lit(3), F.lit(1))
    date_text = F.when(iso, F.concat_ws("-", y, mo, dd)).when(turned, F.concat_ws("", mo, sep, dd, sep, y)).otherwise(F.concat_ws("", dd, sep, mo, sep, y))
    octet = lambda i: F.get(F.split(m, "\\."), F.lit(i)).cast("long")
    ip = _let(
        permute_pair(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), IP_HALVES, salt),
        lambda p: F.concat_ws(
            ".", *[x.cast("string") for h in ("a", "b") for x in (F.floor(p[h] / 256), F.pmod(p[h], F.lit(256)))]
        ),
    )
    country = F.regexp_extract(m, CALLING, 0)
    local = F.substring(m, F.char_length(country) + 1, F.lit(60))
    phone = F.concat(country, _fill(local, "[0-9]", permute_text(digits_of(local), salt, (DIGITS,))))
    ssn = _fill(m, "[0-9]", permute_text(digits_of(m), salt, (DIGITS,)))
    d = digits_of(m)
    body = permute_text(F.substring(d, F.lit(1), F.char_length(d) - 1), salt, (DIGITS,))
    card = _let(
        body,
        lambda b: _fill(
            m, "[0-9]", F.concat(b, F.pmod(10 - F.pmod(luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))
        ),
    )
    out = F.when(kind == "email", email)
    for name, value in (("iban", iban), ("secret", permute_text(m, salt, HEX)), ("date", date_text), ("ip", ip),
                        ("phone", phone), ("ssn", ssn), ("card", card)):
        out = out.when(kind == name, value)
    return out.otherwise(m)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced and the array ``pii`` of (kind, start) findings.

    ``start`` is the finding's place in the original text, in characters from 0.
    """
    docs, back = packed(docs, (text,))
    t = F.col(f"`{text}`")
    m, gaps, kinds, new = (F.col(f"__pii_{x}") for x in ("m", "gaps", "kinds", "new"))
    staged = docs.withColumns(
        {
            "__pii_m": F.coalesce(F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)), F.array().cast("array<string>")),
            "__pii_gaps": F.split(t, CANDIDATE),
        }
    )
    staged = staged.withColumn("__pii_kinds", F.transform(m, _kind))
    staged = staged.withColumn("__pii_new", F.zip_with(kinds, m, lambda k, v: _pseudonym(k, v, key)))
    joined = F.array_join(F.zip_with(gaps, new, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    lengths = F.zip_with(gaps, m, lambda g, v: F.struct(F.char_length(g).alias("g"), F.coalesce(F.char_length(v), F.lit(0)).alias("m")))
    none = F.array().cast("array<int>")
    # Running ends of candidates give their starts.
    ends = F.aggregate(
        lengths, none, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x["g"] + x["m"]))
    )
    starts = F.zip_with(ends, m, lambda e, v: e - F.char_length(v))
    found = F.filter(
        F.zip_with(kinds, starts, lambda k, s: F.struct(k.alias("kind"), s.alias("start"))), lambda x: x["kind"].isNotNull()
    )
    changed = {text: F.when(t.isNotNull(), F.when(F.size(m) > 0, joined).otherwise(t)),
               "__pii_found": F.when(F.size(m) > 0, found).otherwise(F.array().cast("array<struct<kind:string,start:int>>"))}
    return staged.withColumns(changed).select(*back("pii"), F.col("__pii_found").alias("pii"))


def replace_in(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and ``n_chars`` counted again where something was replaced."""
    docs, back = packed(docs, ("text", "n_chars"))
    out = pseudonymise(docs, key)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.size("pii") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted)
    return out.select(*back())
