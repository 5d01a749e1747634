"""Money, rounding and ratio expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: Column | str) -> Column:
    """Amounts are summed as exact decimals, so a total does not depend on the order of the rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def round2(value: Column) -> Column:
    """Two decimals of a double, scaled first and rounded half away from zero.

    ``round(x, 2)`` of Spark rounds the shortest decimal text of ``x`` (1.005 becomes 1.01); the published
    results scale by 100, round and scale back (1.005 becomes 1.0).
    """
    scaled = F.round(value.cast("double") * F.lit(100.0), 0)
    return scaled / F.lit(100.0)


def ratio_pct(part: Column | str, whole: Column | str) -> Column:
    """``part`` as per cent of ``whole``; null when ``whole`` is zero."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def sums_by_value(
    amount: Column | str, by: Column | str, values: Sequence[str], prefix: str, rounded: bool = True
) -> list[Column]:
    """One sum of ``amount`` per listed value of ``by``; zero, not null, where a group has none.

    All sums share one hash aggregation, and the list is fixed, so no extra pass looks for the values.
    """
    by = F.col(by) if isinstance(by, str) else by
    out = []
    for value in values:
        total = F.coalesce(F.sum(F.when(by == value, money(amount))), F.lit(0).cast(MONEY))
        out.append((total.cast("double") if rounded else total).alias(f"{prefix}{value.lower()}"))
    return out
