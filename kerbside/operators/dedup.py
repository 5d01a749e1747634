"""Latest row per key, and duplicate profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], recency: Column | str, ties: Sequence[str] | None = None
) -> DataFrame:
    """Keep the most recent row of every key.

    Equal recency is decided by the ``ties`` columns (all other columns by default), so the result does not
    depend on row order. Spark plans a group limit ahead of the shuffle: a key with very many copies leaves each
    map task as one row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    recency = F.col(recency) if isinstance(recency, str) else recency
    ties = [c for c in df.columns if c not in keys] if ties is None else list(ties)
    order = [recency.desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in ties]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def duplicate_profile(df: DataFrame, key: str, label: str) -> DataFrame:
    """One row: rows, keys that repeat, their share of the rows, and keys whose copies are not identical.

    Copies of a key differ exactly if the least and the greatest hash of its rows do, so only a count and two hashes
    per key and map task are shuffled, whatever the width of the table or the number of copies.
    """
    row_hash = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"), F.min(row_hash).alias("_least"), F.max(row_hash).alias("_greatest")
    )
    repeated = (F.col("_rows") > 1) & F.col(key).isNotNull()
    return per_key.agg(
        F.lit(label).alias("table_name"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("row_count"),
        F.count_if(repeated).alias("duplicated_keys"),
        (F.lit(100.0) * F.count_if(repeated) / F.nullif(F.sum("_rows").cast("double"), F.lit(0.0))).alias(
            "duplicated_pct"
        ),
        F.count_if(repeated & (F.col("_least") != F.col("_greatest"))).alias("conflicting_keys"),
    )
