"""Quality rules: a threshold table compiled into projections of built-in functions.

Every measure is an integer count, every rule a row ``measure * 100 <op> per_cent * base``, so that verdicts are exact.
There is no shuffle and no user function: one pass over the text, row by row.

Cases: a NULL or empty text has no words, fails the base rule and is not kept; a NULL language has no stop-word rule;
repeated rows and repeated ids are judged row by row; an empty table gives an empty table; further columns stay out of
the result of ``measure_quality`` and pass through ``keep_good`` untouched, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import SPACE_WORD

WINDOW = 5

# The commonest function words of each language.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by at this from are or an",
    "fr": "de la le et les des en un du que une pour est dans qui par sur au pas avec",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "es": "de la que el en y los las se del por un con no una su para es al lo",
}


class Rule(NamedTuple):
    """Fails where ``100 * measure`` is above ``most * base``, or below ``least * base``.

    ``from_base``: too little text to judge below this base.
    """

    name: str
    measure: str
    base: str
    least: int | None = None
    most: int | None = None
    languages: tuple[str, ...] | None = None
    from_base: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=25),
    Rule("stop_words", "n_stop_words", "n_words", least=3, languages=tuple(STOP_WORDS), from_base=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _stop_word(word: Column, lang: Column) -> Column:
    lowered = F.lower(word)
    test = F.lit(False)
    for code, words in STOP_WORDS.items():
        test = test | ((lang == code) & lowered.isin(words.split()))
    return test


def _measures(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Adds ``__q``, a struct of all counts.  Each step is a projection of its own, since a later one uses an array
    more than once, and inside lambdas nothing is shared."""
    body = F.coalesce(F.col("__row")[text], F.lit(""))
    # All columns travel as one struct, so that no name can clash.
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    df = df.select(
        "__row",
        F.regexp_extract_all(body, F.lit(SPACE_WORD), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(SPACE_WORD)).alias("lines"),
        F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    language = F.col("__row")[lang].cast("string") if lang in docs.columns else F.lit(None).cast("string")
    df = df.select(
        "__row", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: _stop_word(w, language))).cast("long").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]),
    )
    no_longs = F.array().cast("array<bigint>")
    df = df.withColumn("windows", F.when(F.size("hashes") >= WINDOW, windows).otherwise(no_longs)).drop("hashes")
    # Only texts in which a window occurs twice have their windows sorted.
    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("pairs", F.when(repeats, pairs).otherwise(none)).drop("windows")
    twice = F.filter(
        "pairs",
        lambda p, k: F.coalesce(F.get("pairs", k - 1)["h"] == p["h"], F.lit(False))
        | F.coalesce(F.get("pairs", k + 1)["h"] == p["h"], F.lit(False)),
    )
    df = df.withColumn("starts", F.array_sort(F.transform(twice, lambda p: p["i"]))).drop("pairs")
    gain = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(s - F.get("starts", k - 1), F.lit(WINDOW))))
    df = df.withColumn("n_repeat_words", F.aggregate(gain, F.lit(0).cast("long"), lambda a, b: a + b)).drop("starts")
    counts = [c for c in df.columns if c != "__row"]
    return df.select("__row", F.struct(*counts).alias("__q"), language.alias("__lang"))


def _fails(rule: Rule, q: Column, lang: Column) -> Column:
    measure, base = q[rule.measure] * 100, q[rule.base]
    bad = F.lit(False)
    if rule.most is not None:
        bad = bad | (measure > base * rule.most)
    if rule.least is not None:
        bad = bad | (measure < base * rule.least)
    bad = bad & (base >= rule.from_base)
    return bad if rule.languages is None else bad & F.coalesce(lang.isin(*rule.languages), F.lit(False))


def _verdict(df: DataFrame, rules, min_words: int, max_repeat: int) -> DataFrame:
    q = F.col("__q")
    base = (q["n_words"] < min_words) | (q["n_repeat_words"] * 100 > q["n_words"] * max_repeat)
    failed = F.array_compact(F.array(*[F.when(_fails(r, q, F.col("__lang")), r.name) for r in rules]))
    df = df.select("__row", "__q", base.alias("base_failed"), failed.alias("failed_rules"))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def measure_quality(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
    rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """One row per document: its counts, ``base_failed``, the names of the failed rules and ``kept``."""
    df = _verdict(_measures(docs, text, lang), rules, min_words, max_repeat)
    return df.select(
        F.col("__row")[id_col].alias("doc_id"),
        *[F.col("__q")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept",
        *[F.col("__q")[c].alias(c) for c in ("n_lines", "n_stop_words")],
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def keep_good(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", rules: tuple[Rule, ...] = RULES,
    min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that pass every rule, columns unchanged."""
    # The numbered rows keep the filter above the projections: pushed below, it would repeat them inside each other.
    df = _verdict(_measures(docs, text, lang), rules, min_words, max_repeat)
    df = df.select("__row", "kept", F.monotonically_increasing_id().alias("__n")).where("kept AND __n >= 0")
    return df.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def _sql_rule(rule: Rule) -> str:
    tests = []
    if rule.most is not None:
        tests.append(f"{rule.measure} * 100 > {rule.base} * {rule.most}")
    if rule.least is not None:
        tests.append(f"{rule.measure} * 100 < {rule.base} * {rule.least}")
    test = "(" + " OR ".join(tests) + f") AND {rule.base} >= {rule.from_base}"
    if rule.languages is not None:
        test += " AND coalesce(lang IN (" + ", ".join(f"'{x}'" for x in rule.languages) + "), false)"
    return f"CASE WHEN {test} THEN '{rule.name}' END"


def oracle() -> str:
    stop = " OR ".join(
        "(lang = '%s' AND lower(w) IN (%s))" % (code, ", ".join(f"'{x}'" for x in words.split()))
        for code, words in STOP_WORDS.items()
    )
    rules = ", ".join(_sql_rule(r) for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT r, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS g
    FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice WHERE n > 1) GROUP BY r),
stops AS (SELECT r, count(*) AS n FROM (SELECT r, lang, unnest(ws) AS w FROM w) WHERE {stop} GROUP BY r),
m AS (SELECT doc_id, lang, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(stops.n, 0)::BIGINT AS n_stop_words
    FROM w LEFT JOIN covered USING (r) LEFT JOIN stops USING (r)),
v AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed,
    concat_ws(',', {rules}) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND failed_rules = '' AS kept, n_lines, n_stop_words, failed_rules FROM v
"""
