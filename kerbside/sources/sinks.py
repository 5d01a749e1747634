"""Report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.schemas import PII_COLUMNS


def export_csv(df: DataFrame, path: str, *order: Column, cap: int | None = None) -> None:
    """Export a result for readers as CSV with a header: all rows, or the first ``cap`` where one is given.

    The result is sorted by ``order``, or keeps the order it has. Every task writes its own file; read in the order
    of their names, the files are sorted throughout.
    """
    rows = df.orderBy(*order) if order else df
    rows = rows if cap is None else rows.limit(cap)
    rows.write.mode("overwrite").csv(path, header=True)


def export_closed_months(report: DataFrame, path: str) -> None:
    """Month-close export of the revenue report: every closed month as CSV under its own folder.

    Months of the report replace their folders; those of other months stay. The months are switched one after the other
    at the end, so after a failed run some may be new and others old: run it again before the folder is read.
    """
    closed = report.filter(~F.col("is_partial_month")).drop("is_partial_month")
    months = closed.hint("rebalance", "reference_month").write.partitionBy("reference_month").mode("overwrite")
    months.option("partitionOverwriteMode", "dynamic").csv(path, header=True)


def pii_columns(df: DataFrame) -> list[str]:
    """Columns marked as personal data in the schema, or known as such by name."""
    return [f.name for f in df.schema if f.metadata.get("contains_pii", f.name in PII_COLUMNS)]


def restricted(df: DataFrame, how: str = "hash", key: str | None = None) -> DataFrame:
    """A frame that may leave the platform: marked columns are dropped, or replaced by their SHA-256.

    ``key`` is hashed along, so that short ids cannot be found by trying; keep it where the frame does not go.
    """
    marked = pii_columns(df)
    if how == "drop":
        return df.drop(*marked)
    salted = lambda c: F.col(c).cast("string") if key is None else F.concat(F.lit(key), F.col(c).cast("string"))
    return df.withColumns({c: F.sha2(salted(c), 256) for c in marked})
