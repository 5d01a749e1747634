"""Raw table schemas, the staging rule of each column, personal-data marks and the report contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Staging rules: "keep" passes the column through, "timestamp" and "date" cast it, and "lower", "upper" and
# "trim" clean text. Raw timestamps and dates are declared as text so that a malformed value meets the cast.
_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

# --- fixed values: the columns of the raw tables, in their order ----------------------------------------------
RAW_COLUMNS: dict[str, list[tuple[str, T.DataType, str]]] = {
    "partners": [
        ("partner_id", _S, "keep"),
        ("partner_name", _S, "keep"),
        ("country", _S, "upper"),
        ("tier", _S, "lower"),
        ("status", _S, "lower"),
        ("commission_rate", _D, "keep"),
        ("created_at", _S, "timestamp"),
        ("updated_at", _S, "timestamp"),
        ("contact_email", _S, "lower"),
    ],
    "sessions": [
        ("session_id", _S, "keep"),
        ("user_id", _S, "keep"),
        ("started_at", _S, "timestamp"),
        ("ended_at", _S, "timestamp"),
        ("channel", _S, "lower"),
        ("device", _S, "lower"),
        ("country", _S, "upper"),
        ("page_views", _I, "keep"),
        ("utm_source", _S, "lower"),
        ("utm_campaign", _S, "lower"),
        ("is_bot", _B, "keep"),
    ],
    "searches": [
        ("search_id", _S, "keep"),
        ("session_id", _S, "keep"),
        ("searched_at", _S, "timestamp"),
        ("pickup_location", _S, "trim"),
        ("dropoff_location", _S, "trim"),
        ("pickup_date", _S, "date"),
        ("dropoff_date", _S, "date"),
        ("car_category", _S, "lower"),
        ("num_results", _I, "keep"),
        ("partner_id_clicked", _S, "keep"),
        ("price_shown", _D, "keep"),
    ],
    "bookings": [
        ("booking_id", _S, "keep"),
        ("session_id", _S, "keep"),
        ("user_id", _S, "keep"),
        ("partner_id", _S, "keep"),
        ("booked_at", _S, "timestamp"),
        ("pickup_date", _S, "date"),
        ("dropoff_date", _S, "date"),
        ("pickup_location", _S, "trim"),
        ("car_category", _S, "lower"),
        ("daily_rate", _D, "keep"),
        ("total_amount", _D, "keep"),
        ("currency", _S, "upper"),
        ("status", _S, "lower"),
        ("payment_method", _S, "lower"),
    ],
    "cancellations": [
        ("cancellation_id", _S, "keep"),
        ("booking_id", _S, "keep"),
        ("cancelled_at", _S, "timestamp"),
        ("reason", _S, "lower"),
        ("cancelled_by", _S, "lower"),
        ("refund_amount", _D, "keep"),
        ("refund_status", _S, "lower"),
        ("days_before_pickup", _I, "keep"),
    ],
}

PII_COLUMNS = frozenset({"user_id", "contact_email"})

REVENUE_CONTRACT = T.StructType(
    [
        T.StructField("partner_id", _S, False),
        T.StructField("partner_name", _S, False),
        T.StructField("reference_month", T.DateType(), False),
        T.StructField("currency", _S, False),
        T.StructField("revenue_amount", T.DecimalType(28, 2), False),
        T.StructField("booking_count", T.LongType(), False),
        T.StructField("excluded_invalid_amount_count", T.LongType(), False),
        T.StructField("flagged_suspicious_booking_count", T.LongType(), False),
        T.StructField("is_partial_month", _B, False),
    ]
)


def raw_schema(table: str) -> T.StructType:
    """Explicit schema of a raw table."""
    return T.StructType([T.StructField(name, dtype, True) for name, dtype, _ in RAW_COLUMNS[table]])


def column_metadata(name: str) -> dict[str, bool]:
    """Metadata attached to every staged column; it follows the column through later projections."""
    return {"contains_pii": name in PII_COLUMNS}
