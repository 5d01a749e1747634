"""Fixed values of the business domain.

These must be equal to the published definitions for results to agree; they are stated here once, as plain text.
"""

# --- fixed values: booking life cycle -------------------------------------------------------------------------
REVENUE_STATUSES = ("confirmed", "completed")
ACTIVE_STATUS = "active"
PARTNER_STATUSES = ("active", "inactive", "suspended")

# --- fixed values: reporting currencies, in column order ------------------------------------------------------
CURRENCIES = ("BRL", "USD", "ARS", "CLP", "COP")

# --- fixed values: car categories -----------------------------------------------------------------------------
CAR_CATEGORIES = ("economy", "suv", "luxury", "pickup", "minivan")
KNOWN_EXTRA_CATEGORY = "compact"

# --- fixed values: commission range ---------------------------------------------------------------------------
COMMISSION_MIN = 0.05
COMMISSION_MAX = 0.30

# --- fixed values: labels shown to readers of the reports -----------------------------------------------------
UNKNOWN_LABEL = "Não identificado"
NULL_CATEGORY_LABEL = "(nulo)"
BOT_CAUGHT_LABEL = "flag is_bot já detectou"
BOT_MISSED_LABEL = "escapou da flag is_bot"
FUNNEL_STAGES = ("Sessões", "Buscas", "Reservas")

# --- fixed values: analysis parameters ------------------------------------------------------------------------
TRAILING_DAYS = 90
TOP_PARTNERS = 10
BURST_SECONDS = 300
BURST_THRESHOLD = 50
SIGMAS = 2.0
IQR_FACTOR = 1.5
LONG_SESSION_HOURS = 6

# --- fixed values: alert limits, per cent of the stated population ---------------------------------------------
ALERT_LIMITS_PCT = {
    "negative_days_before_pickup": 3.0,
    "same_user_day": 0.5,
    "amount_outliers": 1.0,
    "long_sessions": 1.0,
    "click_without_result": 2.0,
    "refund_over_total": 20.0,
    "unknown_category": 0.0,
}
COMPLETENESS_LIMIT_PCT = 2.0
CONTRACT_GRAIN = ("partner_id", "reference_month", "currency")
SUSPICIOUS_LIMIT_PCT = 0.5
NULL_RATE_TOLERANCE_PP = 3.0
FRESHNESS_HOURS = 24
