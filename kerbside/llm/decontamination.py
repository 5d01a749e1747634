"""Benchmark decontamination: a prefix-filtered set join of item windows with documents. Built-in functions only.

A window is ``size`` consecutive words of an item, or a whole shorter item. Its set holds its word shingles with their
offsets. Containment asks for all of them, so of the shingles ordered by rarity (documents' frequency) the necessary
prefix is the rarest one: only these are joined. A match must leave room for the window before and behind it (positional
and length bounds), and is then verified word by word.

Defined results: a null text has no words; items without words match nothing; equal windows of several items count for
each; repeated document rows get a row each; items are counted by id, null ids left out; an empty benchmark marks nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import documents, lower_ascii, with_row_key, word_array
from kerbside.session import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return word_array(lower_ascii(text), SEPARATORS)


def _shingle(words: str, at: Column, length: int) -> Column:
    """Hash of ``length`` words from place ``at``."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + i) for i in range(length)])


def _shingles(length: int) -> Column:
    """Hashes of all shingles of the column ``words``, by place."""
    count = F.greatest(F.size("words") - (length - 1), F.lit(0))
    return F.transform(F.slice("words", 1, count), lambda w, i: F.xxhash64(F.lit(length), w, *[F.get("words", i + k) for k in range(1, length)]))


def item_windows(benchmark: DataFrame, size: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, window): the distinct windows of each item, as arrays of words."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), _words(F.col(text_col).cast("string")).alias("words"))
    items = items.filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    windows = items.select("item", "words", F.explode(starts).alias("start"))
    return windows.select("item", F.slice("words", F.col("start"), size).alias("window")).distinct()


def _document_shingles(docs: DataFrame, lengths: list[int], keep: tuple[str, ...]) -> DataFrame:
    """One row for every shingle of every document: the kept columns, its place and its hash."""
    parts = [docs.select(*keep, F.posexplode(_shingles(n)).alias("place", "shingle")) for n in lengths]
    return reduce(DataFrame.unionByName, parts)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 13,
    min_percent: int = 5,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    with_key: bool = False,
) -> DataFrame:
    """Per document: id, n_words, n_hit (words inside an occurrence), n_items, items_sha256, contaminated.

    ``with_key`` adds ``row_key``, the hash of id and text, which tells apart rows that share an id."""
    keyed = with_row_key(documents(docs, id_col, text_col))
    split = keyed.select("doc_id", "row_key", _words(F.col("text")).alias("words"))
    item_window = materialise(item_windows(benchmark, size, item_col, item_text_col), "benchmark-windows")
    windows = item_window.select("window").distinct().select("window", F.xxhash64("window").alias("window_key"))
    windows = windows.withColumn("length", F.size("window"))
    # The shingle length is fixed but for items that are shorter themselves; at most ``shingle`` values.
    lengths = [r[0] for r in windows.select(F.least("length", F.lit(shingle)).alias("n")).distinct().collect()]
    if not lengths:
        lengths = [shingle]
    offsets = F.sequence(F.lit(0), F.col("length") - F.least("length", F.lit(shingle)))
    placed = windows.select("*", F.explode(offsets).alias("offset"))
    by_length = F.lit(None).cast("long")
    for n in lengths:
        by_length = F.when(F.least("length", F.lit(shingle)) == n, _shingle("window", F.col("offset"), n)).otherwise(by_length)
    placed = materialise(placed.select("window_key", "length", "offset", by_length.alias("shingle")), "benchmark-shingles")

    # Order by rarity: frequency of the items' shingles in all documents.
    wanted = materialise(placed.select("shingle").distinct(), "benchmark-wanted")
    seen = _document_shingles(split, lengths, ()).join(wanted, "shingle", "left_semi")
    frequency = seen.groupBy("shingle").agg(F.count("*").alias("n"))
    # A shingle that is nowhere rules its windows out: its frequency of 0 makes it the rarest, and it joins nothing.
    rarest = placed.join(frequency, "shingle", "left").groupBy("window_key", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("first")
    )
    rarest = rarest.filter("first.n > 0").select("window_key", "length", F.col("first.shingle").alias("shingle"), F.col("first.offset").alias("offset"))
    prefix = materialise(rarest, "benchmark-prefixes")

    sized = split.withColumn("n_words", F.size("words"))
    found = _document_shingles(sized, lengths, ("doc_id", "row_key", "n_words")).join(prefix, "shingle")
    found = found.withColumn("start", F.col("place") - F.col("offset"))
    found = found.filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    spots = found.select("doc_id", "row_key", "start", "window_key").distinct()
    spots = spots.join(windows.select("window_key", "window"), "window_key")
    spots = spots.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "window_key", "window")).alias("spots"))
    spots = materialise(spots.withColumnRenamed("doc_id", "spot_id").withColumnRenamed("row_key", "spot_key"), "benchmark-spots")

    same_row = (F.col("row_key") == F.col("spot_key")) & F.col("doc_id").eqNullSafe(F.col("spot_id"))
    both = split.join(spots, same_row, "left")
    true_spots = F.filter(
        F.coalesce("spots", F.expr("cast(array() as array<struct<start: int, window_key: bigint, window: array<string>>>)")),
        lambda s: F.slice("words", s["start"] + 1, F.size(s["window"])) == s["window"],
    )
    both = both.select("doc_id", "row_key", F.size("words").cast("long").alias("n_words"), true_spots.alias("spots"))
    covered = F.flatten(F.transform("spots", lambda s: F.sequence(s["start"], s["start"] + F.size(s["window"]) - 1)))
    both = both.select(
        "doc_id",
        "row_key",
        "n_words",
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("spots", lambda s: s["window_key"])).alias("hit_windows"),
    )
    both = materialise(both, "benchmark-hits")
    hit_items = (
        both.filter(F.size("hit_windows") > 0)
        .select("doc_id", "row_key", F.explode("hit_windows").alias("window_key"))
        .distinct()
        .join(item_window.select("item", F.xxhash64("window").alias("window_key")), "window_key")
        .groupBy(F.col("doc_id").alias("item_doc"), F.col("row_key").alias("item_key"))
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    out = both.join(hit_items, (F.col("row_key") == F.col("item_key")) & F.col("doc_id").eqNullSafe(F.col("item_doc")), "left")
    items = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select(
        "doc_id",
        *(["row_key"] if with_key else []),
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not contaminated, with all their columns."""
    found = contamination(df, benchmark, id_col=id_col, text_col=text_col, with_key=True).filter("contaminated")
    found = materialise(found.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct(), "contaminated")
    key = F.xxhash64(df[id_col], df[text_col].cast("string"))
    return df.join(found, (key == found["_key"]) & df[id_col].eqNullSafe(found["_id"]), "left_anti")
