"""Quality rules: a table of thresholds compiled into one projection of ratios. Built-in functions only.

Defined results: a null or empty text has no words and fails the base rule; a null or unlisted language skips the
stop-word rule; repeated rows are judged one by one; other columns of the input are never read; an empty table gives an
empty table. A text is judged inside its own row, so nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import word_array

# The most frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by are this at from or an have not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es",
    "fr": "de la le et les des en un du une que pour est dans qui par au pas sur se plus ne",
    "es": "de la que el en y los se del las un por con no una para su al lo como es más",
}
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Keep a text while low <= 100 * part / whole <= high. ``languages`` limits a rule to texts in these languages."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    languages: tuple[str, ...] | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", low=300, high=1000),
    Rule("symbols", "n_symbols", "n_words", high=20),
    Rule("stop_words", "n_stop_words", "n_words", low=6, languages=tuple(STOP_WORDS)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=40),
)


def _compile(rule: Rule, lang: Column) -> Column:
    """True where a row breaks the rule; null values break nothing."""
    part, whole = F.col(rule.part) * 100, F.col(rule.whole)
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (part < whole * rule.low)
    if rule.high is not None:
        broken = broken | (part > whole * rule.high)
    if rule.languages is not None:
        broken = broken & lang.isin(*rule.languages)
    return F.coalesce(broken, F.lit(False))


def quality_rules(
    df: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """Per row: id, the counts, ``base_failed``, one ``breaks_<rule>`` per rule and ``kept``.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them in repeated 3-word windows.
    """
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stop_words = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    rows = df.select(F.col(id_col).alias("doc_id"), lang.alias("lang"), text.alias("text"), word_array(F.col(text_col)).alias("words"))
    starts = F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0)))
    rows = rows.select(
        "doc_id",
        "lang",
        "text",
        "words",
        F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line, F.lit(" \t\x0b\x0c\r"))) > 0).alias("lines"),
        F.transform(starts, lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))).alias("hashes"),
    )
    # Equal windows have equal hashes: texts whose hashes all differ, most of them, never build or sort the windows.
    windows = F.transform(
        starts,
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)).alias("w"), i.alias("i")),
    )
    none = F.expr("cast(array() as array<struct<w: string, i: int>>)")
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.select("doc_id", "lang", "text", "words", "lines", F.when(repeats, F.sort_array(windows)).otherwise(none).alias("pairs"))
    same = lambda p, other: F.coalesce(p["w"] == F.get("pairs", other)["w"], F.lit(False))
    places = F.sort_array(F.transform(F.filter("pairs", lambda p, i: same(p, i - 1) | same(p, i + 1)), lambda p: p["i"]))
    rows = rows.withColumn("places", places)
    reach = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    counts = rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(reach, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(*stop_words))).cast("long").alias("n_stop_words"),
    )
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = counts.select("*", base_failed.alias("base_failed"), *[_compile(r, F.col("lang")).alias(f"breaks_{r.name}") for r in rules])
    broken = F.lit(False)
    for r in rules:
        broken = broken | F.col(f"breaks_{r.name}")
    return judged.select("*", (~F.col("base_failed") & ~broken).alias("kept")).drop("lang")
