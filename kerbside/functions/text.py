"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(column: Column | str, rule: str, strict: bool = True) -> Column:
    """Apply one staging rule. With ``strict=False`` a value that cannot be cast becomes null instead of failing."""
    column = F.col(column) if isinstance(column, str) else column
    if rule == "keep":
        return column
    if rule in ("timestamp", "date"):
        target = "timestamp_ntz" if rule == "timestamp" else "date"
        return column.cast(target) if strict else column.try_cast(target)
    trimmed = F.trim(column)
    return {"trim": trimmed, "lower": F.lower(trimmed), "upper": F.upper(trimmed)}[rule]


def blank_as(column: Column | str, label: str) -> Column:
    """Null, empty or all-space text becomes ``label``."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(label))
