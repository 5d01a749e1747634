"""SQL (DuckDB) that each registered query must agree with, over the same parquet tables."""

from __future__ import annotations

BOOKING_CUT = "1999-07-10 00:00:00"
MOVED_TO = "2002-01-15 00:00:00"
SESSION_CUT = "2024-01-16 00:00:00"

# -- the five raw tables ----------------------------------------------------------------------------------------
RAW = """
line_head AS (
  SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_partkey) AS partkey FROM lineitem GROUP BY l_orderkey),
p0 AS (
  SELECT 'PRT' || CAST(s_suppkey AS VARCHAR) AS partner_id, s_name AS partner_name, n_name AS country,
    CASE s_suppkey % 4 WHEN 0 THEN 'gold' WHEN 1 THEN 'Silver ' WHEN 2 THEN 'bronze' END AS tier,
    CASE WHEN s_suppkey % 7 = 3 THEN 'inactive' WHEN s_suppkey % 5 = 2 THEN 'Active' ELSE 'active' END AS status,
    CASE WHEN s_suppkey % 9 = 8 THEN 0.35e0 ELSE 0.05e0 + (s_suppkey % 26) / 100e0 END AS commission_rate,
    TIMESTAMP '2020-01-01 00:00:00' AS created_at,
    CASE WHEN s_suppkey % 3 > 0 THEN TIMESTAMP '2023-06-01 00:00:00' END AS updated_at,
    CASE WHEN s_suppkey % 6 > 0 THEN 'OPS' || CAST(s_suppkey AS VARCHAR) || '@Example.com ' END AS contact_email,
    s_suppkey AS k
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
raw_partners AS (SELECT * EXCLUDE (k) FROM (SELECT * FROM p0 UNION ALL SELECT * FROM p0 WHERE k % 10 = 1)),
s0 AS (
  SELECT CAST(e.user_id AS VARCHAR) || '-' || CAST(extract(day FROM e.ts) AS VARCHAR) AS session_id,
    CASE WHEN e.user_id % 8 <> 7 THEN 'U' || CAST(e.user_id AS VARCHAR) END AS user_id,
    min(e.ts) AS started_at,
    CASE WHEN min(e.event_id) % 25 <> 0 THEN max(e.ts) END AS ended_at,
    CASE e.user_id % 4 WHEN 0 THEN 'google_cpc' WHEN 1 THEN 'Direct ' WHEN 2 THEN 'affiliate' ELSE 'email' END AS channel,
    CASE WHEN e.user_id % 3 = 0 THEN lower(min(c_mktsegment)) WHEN e.user_id % 29 = 1 THEN '  ' ELSE min(c_mktsegment) END AS device,
    CASE WHEN e.user_id % 2 = 0 THEN lower(min(n_name)) ELSE min(n_name) END AS country,
    count(*) AS page_views,
    CASE WHEN e.user_id % 10 >= 3 THEN CASE WHEN e.user_id % 2 = 0 THEN ' Google' ELSE 'newsletter' END END AS utm_source,
    CASE WHEN e.user_id % 10 >= 3 THEN 'CAMP' || CAST(e.user_id % 5 AS VARCHAR) END AS utm_campaign,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 2 AS is_bot, e.user_id AS k
  FROM events e JOIN customer ON e.user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY e.user_id, extract(day FROM e.ts)),
raw_sessions AS (SELECT * EXCLUDE (k) FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s0 WHERE k % 20 = 4)),
q0 AS (
  SELECT 'SRC' || CAST(event_id AS VARCHAR) AS search_id,
    CAST(user_id AS VARCHAR) || '-' || CAST(extract(day FROM ts) AS VARCHAR) AS session_id,
    ts AS searched_at,
    ' City ' || CAST(event_id % 50 AS VARCHAR) AS pickup_location,
    'City ' || CAST(event_id % 40 AS VARCHAR) || ' ' AS dropoff_location,
    CAST(ts AS date) AS pickup_date,
    CASE WHEN event_id % 113 = 0 THEN DATE '2023-12-01' ELSE DATE '2024-03-01' END AS dropoff_date,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE
      CASE event_id % 6 WHEN 0 THEN 'economy' WHEN 1 THEN ' Standard' WHEN 2 THEN 'MEDIUM ' WHEN 3 THEN 'large'
        WHEN 4 THEN 'small' ELSE 'promo' END END AS car_category,
    CAST(floor(value) AS BIGINT) % 5 AS num_results,
    CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 71 = 0 THEN 'PRT-unknown' ELSE 'PRT' || CAST(event_id % 10 AS VARCHAR) END END AS partner_id_clicked,
    value AS price_shown, event_id AS k
  FROM events WHERE event_type IN ('view', 'click')),
raw_searches AS (SELECT * EXCLUDE (k) FROM (SELECT * FROM q0 UNION ALL SELECT * FROM q0 WHERE k % 50 = 0)),
b0 AS (
  SELECT 'BKG' || CAST(o_orderkey AS VARCHAR) AS booking_id,
    CAST(o_custkey AS VARCHAR) || '-' || CAST(extract(day FROM o_orderdate) AS VARCHAR) AS session_id,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'U' || CAST(o_custkey AS VARCHAR) END AS user_id,
    'PRT' || CAST(suppkey AS VARCHAR) AS partner_id,
    o_orderdate AS booked_at,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS pickup_date,
    CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) - 1
      ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) + CAST(o_orderkey % 10 + 1 AS INTEGER) END AS dropoff_date,
    ' City ' || CAST(o_orderkey % 50 AS VARCHAR) AS pickup_location,
    CASE WHEN o_orderkey % 31 <> 0 THEN ' ' || p_type END AS car_category,
    o_totalprice / 8e0 AS daily_rate,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_totalprice
         WHEN o_orderkey % 83 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS total_amount,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BRL' WHEN '2' THEN 'usd' WHEN '3' THEN 'ARS' WHEN '4' THEN 'CLP ' ELSE 'COP' END AS currency,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Confirmed ' ELSE 'pending' END AS status,
    CASE o_orderkey % 4 WHEN 1 THEN 'Credit_Card ' WHEN 2 THEN 'pix' WHEN 3 THEN 'boleto' END AS payment_method,
    o_orderkey AS k
  FROM orders LEFT JOIN line_head ON o_orderkey = l_orderkey LEFT JOIN part ON partkey = p_partkey),
raw_bookings AS (SELECT * EXCLUDE (k) FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE k % 150 = 0)),
raw_cancellations AS (
  SELECT 'CAN' || CAST(l_orderkey AS VARCHAR) AS cancellation_id, 'BKG' || CAST(l_orderkey AS VARCHAR) AS booking_id,
    l_shipdate AS cancelled_at,
    CASE l_suppkey % 3 WHEN 0 THEN 'Changed plans ' WHEN 1 THEN 'price' ELSE 'No Show' END AS reason,
    CASE WHEN l_suppkey % 2 = 0 THEN 'User' ELSE 'partner ' END AS cancelled_by,
    CASE WHEN l_quantity <= 45 THEN l_extendedprice END AS refund_amount,
    CASE WHEN l_suppkey % 5 = 0 THEN 'Pending' ELSE 'done' END AS refund_status,
    CAST(l_quantity AS BIGINT) - 3 AS days_before_pickup
  FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)
"""

# -- staging, intermediate, marts -------------------------------------------------------------------------------
STG = """
stg_partners AS (
  SELECT partner_id, partner_name, upper(trim(country)) AS country, lower(trim(tier)) AS tier, lower(trim(status)) AS status,
    commission_rate, created_at, updated_at, lower(trim(contact_email)) AS contact_email FROM raw_partners),
stg_sessions AS (
  SELECT session_id, user_id, started_at, ended_at, lower(trim(channel)) AS channel, lower(trim(device)) AS device,
    upper(trim(country)) AS country, page_views, lower(trim(utm_source)) AS utm_source,
    lower(trim(utm_campaign)) AS utm_campaign, is_bot FROM raw_sessions),
stg_searches AS (
  SELECT search_id, session_id, searched_at, trim(pickup_location) AS pickup_location, trim(dropoff_location) AS dropoff_location,
    pickup_date, dropoff_date, lower(trim(car_category)) AS car_category, num_results, partner_id_clicked, price_shown
  FROM raw_searches),
stg_bookings AS (
  SELECT booking_id, session_id, user_id, partner_id, booked_at, pickup_date, dropoff_date,
    trim(pickup_location) AS pickup_location, lower(trim(car_category)) AS car_category, daily_rate, total_amount,
    upper(trim(currency)) AS currency, lower(trim(status)) AS status, lower(trim(payment_method)) AS payment_method
  FROM raw_bookings),
stg_cancellations AS (
  SELECT cancellation_id, booking_id, cancelled_at, lower(trim(reason)) AS reason, lower(trim(cancelled_by)) AS cancelled_by,
    refund_amount, lower(trim(refund_status)) AS refund_status, days_before_pickup FROM raw_cancellations)
"""

INT = """
int_partners AS (
  SELECT DISTINCT ON (partner_id) * FROM stg_partners ORDER BY partner_id, coalesce(updated_at, created_at) DESC),
int_sessions AS (
  SELECT DISTINCT ON (session_id) * EXCLUDE (is_bot) FROM stg_sessions WHERE is_bot = false
  ORDER BY session_id, started_at DESC),
int_searches AS (
  SELECT DISTINCT ON (search_id) * FROM stg_searches
  WHERE session_id IN (SELECT session_id FROM int_sessions) ORDER BY search_id, searched_at DESC),
active_bookings AS (
  SELECT DISTINCT ON (booking_id) * FROM stg_bookings
  WHERE partner_id IN (SELECT partner_id FROM stg_partners WHERE status = 'active') ORDER BY booking_id, booked_at DESC),
int_bookings AS (
  SELECT * FROM active_bookings WHERE total_amount > 0 OR status NOT IN ('confirmed', 'completed')),
latest_cancellations AS (
  SELECT DISTINCT ON (c.cancellation_id) c.*, b.total_amount AS booking_total_amount
  FROM stg_cancellations c JOIN (SELECT DISTINCT booking_id, total_amount FROM stg_bookings) b USING (booking_id)
  ORDER BY c.cancellation_id, c.cancelled_at DESC NULLS LAST, c.booking_id DESC NULLS LAST, c.reason DESC NULLS LAST,
    c.cancelled_by DESC NULLS LAST, c.refund_amount DESC NULLS LAST, c.refund_status DESC NULLS LAST,
    c.days_before_pickup DESC NULLS LAST),
int_cancellations AS (
  SELECT * EXCLUDE (booking_total_amount) FROM latest_cancellations
  WHERE refund_amount IS NULL OR refund_amount <= booking_total_amount),
dim_partners AS (SELECT * FROM int_partners),
dim_users AS (
  SELECT u.user_id, f.first_seen_at FROM (
    SELECT user_id FROM int_sessions WHERE user_id IS NOT NULL UNION
    SELECT user_id FROM int_bookings WHERE user_id IS NOT NULL) u
  LEFT JOIN (SELECT user_id, min(started_at) AS first_seen_at FROM int_sessions GROUP BY user_id) f ON f.user_id = u.user_id),
fct_bookings AS (SELECT * FROM int_bookings),
fct_sessions AS (SELECT * FROM int_sessions),
standing AS (
  SELECT * FROM fct_bookings b WHERE status IN ('confirmed', 'completed')
    AND NOT EXISTS (SELECT 1 FROM int_cancellations c WHERE c.booking_id = b.booking_id))
"""


def _on(sql: str, *ctes: str) -> str:
    return "WITH " + ",".join([RAW, STG, INT, *ctes]) + "\n" + sql


def _sums(prefix: str) -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN currency = '{c}' THEN CAST(total_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS {prefix}{c.lower()}"
        for c in ("BRL", "USD", "ARS", "CLP", "COP")
    )


def _big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


# -- funnel -----------------------------------------------------------------------------------------------------
def _flags(statuses: str = "") -> str:
    return f"""flags AS (
  SELECT s.session_id, coalesce(nullif(trim(s.country), ''), 'Não identificado') AS pais,
    coalesce(nullif(trim(s.device), ''), 'Não identificado') AS dispositivo,
    s.session_id IN (SELECT session_id FROM int_searches) AS searched,
    s.session_id IN (SELECT session_id FROM fct_bookings b WHERE NOT EXISTS (
      SELECT 1 FROM int_cancellations c WHERE c.booking_id = b.booking_id) {statuses}) AS booked
  FROM int_sessions s)"""


FUNNEL = """SELECT pais, dispositivo, total_sessoes, sessoes_com_busca, sessoes_com_reserva,
  round(100e0 * sessoes_com_busca / nullif(total_sessoes, 0), 2) AS taxa_sessao_para_busca_pct,
  round(100e0 * sessoes_com_reserva / nullif(sessoes_com_busca, 0), 2) AS taxa_busca_para_reserva_pct,
  round(100e0 * sessoes_com_reserva / nullif(total_sessoes, 0), 2) AS taxa_conversao_geral_pct
FROM (SELECT pais, dispositivo, count(DISTINCT session_id) AS total_sessoes,
  count(DISTINCT CASE WHEN searched THEN session_id END) AS sessoes_com_busca,
  count(DISTINCT CASE WHEN booked THEN session_id END) AS sessoes_com_reserva FROM flags GROUP BY pais, dispositivo)"""

STAGES = """SELECT 'Sessões' AS etapa, CAST(1 AS BIGINT) AS ordem, count(*) AS valor FROM flags
UNION ALL SELECT 'Buscas', 2, count(*) FROM flags WHERE searched
UNION ALL SELECT 'Reservas', 3, count(*) FROM flags WHERE booked"""


# -- cohorts ----------------------------------------------------------------------------------------------------
def _cohort(pattern: str) -> str:
    means = ", ".join(
        f"round(CAST(sum(coalesce({c}, 0)) AS DOUBLE) / count(*), 2) AS ltv_medio_{c}" for c in ("brl", "usd", "ars", "clp", "cop")
    )
    spent = ", ".join(
        f"sum(CASE WHEN currency = '{c.upper()}' THEN CAST(total_amount AS DECIMAL(18,2)) ELSE 0 END) AS {c}"
        for c in ("brl", "usd", "ars", "clp", "cop")
    )
    return _on(
        f"""SELECT strftime(first_seen_at, '{pattern}') AS cohort_mes_ano, count(*) AS quantidade_usuarios, {means}
FROM dim_users u LEFT JOIN spent s ON u.user_id = s.user_id WHERE first_seen_at IS NOT NULL GROUP BY 1""",
        f"spent AS (SELECT user_id, {spent} FROM standing WHERE user_id IS NOT NULL GROUP BY user_id)",
    )


# -- cancellation rates -----------------------------------------------------------------------------------------
def _rates(same_population: bool = False) -> str:
    extra = "AND b.status IN ('confirmed', 'completed')" if same_population else ""
    return f"""rates AS (
  SELECT r.partner_id, n, coalesce(c, 0) AS c, 100e0 * coalesce(c, 0) / n AS taxa
  FROM (SELECT partner_id, count(*) AS n FROM fct_bookings WHERE status IN ('confirmed', 'completed') GROUP BY 1) r
  LEFT JOIN (SELECT b.partner_id, count(*) AS c FROM int_cancellations x JOIN fct_bookings b ON x.booking_id = b.booking_id {extra}
    GROUP BY 1) k ON r.partner_id = k.partner_id),
stats AS (SELECT avg(taxa) AS m, stddev_pop(taxa) AS s FROM rates)"""


def _outliers(sigmas: str, same_population: bool = False, lower: bool = False) -> str:
    more = f", round(m - {sigmas} * s, 2) AS limite_inferior_2sigma" if lower else ""
    return _on(
        f"""SELECT partner_name AS parceiro, n AS quantidade_reservas, c AS quantidade_cancelamentos,
  round(taxa, 2) AS taxa_cancelamento_pct, round(m, 2) AS media_geral_pct, round(s, 2) AS desvio_padrao_pct,
  round(m + {sigmas} * s, 2) AS limite_superior_2sigma, taxa > m + {sigmas} * s AS eh_outlier{more}
FROM rates JOIN dim_partners USING (partner_id), stats""",
        _rates(same_population),
    )


# -- bursts -----------------------------------------------------------------------------------------------------
FIXED_PEAKS = """peaks AS (
  SELECT session_id, max(n) AS peak FROM (
    SELECT session_id, time_bucket(INTERVAL 5 MINUTE, searched_at) AS b, count(*) AS n FROM stg_searches GROUP BY 1, 2)
  GROUP BY 1 HAVING max(n) > 1)"""
SLIDING_PEAKS = """peaks AS (
  SELECT session_id, max(n) AS peak FROM (
    SELECT session_id, count(*) OVER (PARTITION BY session_id ORDER BY CAST(floor(epoch(searched_at)) AS BIGINT)
      RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS n FROM stg_searches)
  GROUP BY 1 HAVING max(n) > 1)"""


def _bursts(peaks: str, distinct: str = "") -> str:
    return _on(
        f"""SELECT {distinct} s.session_id, peak AS pico_buscas_5min, is_bot AS ja_marcada_como_bot,
  CASE WHEN is_bot THEN 'flag is_bot já detectou' ELSE 'escapou da flag is_bot' END AS status_deteccao
FROM peaks p JOIN stg_sessions s ON p.session_id = s.session_id""",
        peaks,
    )


# -- violations -------------------------------------------------------------------------------------------------
CLICKS = """SELECT search_id, session_id, num_results, partner_id_clicked FROM int_searches
WHERE num_results = 0 AND partner_id_clicked IS NOT NULL"""
LONG = """SELECT session_id, started_at, ended_at, date_diff('hour', started_at, ended_at) AS duracao_horas FROM int_sessions
WHERE ended_at IS NOT NULL AND date_diff('hour', started_at, ended_at) > 6"""
IQR_BASE = """iqr_base AS (
  SELECT booking_id, coalesce(car_category, '(nulo)') AS car_category, total_amount FROM int_bookings
  WHERE status IN ('confirmed', 'completed') AND total_amount > 0),
iqr AS (SELECT car_category, q3 + 1.5 * (q3 - q1) AS limite_superior FROM (
  SELECT car_category, quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3
  FROM iqr_base GROUP BY car_category))"""
IQR = """SELECT booking_id, car_category, total_amount, round(limite_superior, 6) AS limite_superior FROM iqr_base JOIN iqr USING (car_category)
WHERE total_amount > limite_superior"""
REFUNDS = """SELECT c.cancellation_id, c.booking_id, c.refund_amount, b.total_amount, count(*) AS copies
FROM stg_cancellations c JOIN stg_bookings b ON c.booking_id = b.booking_id WHERE c.refund_amount > b.total_amount
GROUP BY ALL"""
USER_DAYS = """SELECT user_id, CAST(booked_at AS DATE) AS booked_date, count(*) AS qtd_reservas_no_dia FROM int_bookings
WHERE user_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""


# -- quality ----------------------------------------------------------------------------------------------------
def _result(model: str, check: str, column: str, severity: str, failing: str, values: str, population: str, source: str) -> str:
    failures = values if check == "unique" else failing
    return f"""SELECT '{model}' AS model, '{check}' AS "check", '{column}' AS "column", '{severity}' AS severity,
  {_big(failing)} AS failing_rows, {_big(values)} AS failing_values, {_big(population)} AS population,
  round(100e0 * ({failures}) / nullif({population}, 0), 2) AS rate_pct,
  CASE WHEN ({failures}) = 0 THEN 'pass' ELSE '{severity}' END AS status FROM {source}"""


def _row(model: str, check: str, column: str, severity: str, bad: str, where: str = "true") -> str:
    return _result(
        model, check, column, severity, f"count(*) FILTER (WHERE ({where}) AND ({bad}))", "NULL",
        f"count(*) FILTER (WHERE {where})", model,
    )


def _key(model: str, check: str, column: str, severity: str, bad: str) -> str:
    return _result(
        model, check, column, severity, f"coalesce(sum(n) FILTER (WHERE {bad}), 0)", f"count(*) FILTER (WHERE {bad})",
        "coalesce(sum(n), 0)", f"(SELECT {column} AS value, count(*) AS n FROM {model} GROUP BY 1)",
    )


def _not_null(model: str, column: str) -> str:
    return _row(model, "not_null", column, "error", f"{column} IS NULL")


def _unique(model: str, column: str, severity: str = "error") -> str:
    return _key(model, "unique", column, severity, "value IS NOT NULL AND n > 1")


def _accepted(model: str, column: str, severity: str, values: str) -> str:
    return _key(model, "accepted_values", column, severity, f"value NOT IN ({values})")


def _related(model: str, column: str, severity: str, parent: str, parent_column: str) -> str:
    return _key(
        model, "relationships", column, severity,
        f"value IS NOT NULL AND value NOT IN (SELECT {parent_column} FROM {parent})",
    )


_CATEGORIES = "'economy', 'standard', 'medium', 'large', 'small'"
_NOT_NULL = [
    ("stg_partners", "partner_id"), ("stg_sessions", "session_id"), ("stg_searches", "search_id"),
    ("stg_searches", "session_id"), ("stg_bookings", "booking_id"), ("stg_bookings", "partner_id"),
    ("stg_cancellations", "cancellation_id"), ("stg_cancellations", "booking_id"), ("int_searches", "search_id"),
    ("int_searches", "session_id"), ("int_partners", "partner_id"), ("dim_partners", "partner_id"),
    ("dim_users", "user_id"), ("fct_bookings", "booking_id"), ("fct_sessions", "session_id"),
]
_UNIQUE = [
    ("stg_partners", "partner_id", "warn"), ("stg_sessions", "session_id", "warn"), ("stg_searches", "search_id", "warn"),
    ("stg_bookings", "booking_id", "warn"), ("stg_cancellations", "cancellation_id", "warn"),
    ("int_searches", "search_id", "error"), ("int_partners", "partner_id", "error"), ("dim_partners", "partner_id", "error"),
    ("dim_users", "user_id", "error"), ("fct_bookings", "booking_id", "error"), ("fct_sessions", "session_id", "error"),
]
DQ = {
    "not_null": [_not_null(*c) for c in _NOT_NULL],
    "unique": [_unique(*c) for c in _UNIQUE],
    "accepted_values": [
        _accepted("stg_searches", "car_category", "warn", _CATEGORIES),
        _accepted("stg_bookings", "car_category", "warn", _CATEGORIES),
        _accepted("dim_partners", "status", "error", "'active', 'inactive', 'suspended'"),
    ],
    "relationships": [
        _related("int_searches", "partner_id_clicked", "warn", "int_partners", "partner_id"),
        _related("fct_bookings", "user_id", "error", "dim_users", "user_id"),
        _related("fct_bookings", "partner_id", "error", "dim_partners", "partner_id"),
        _related("fct_sessions", "user_id", "error", "dim_users", "user_id"),
    ],
    "between": [
        _row("stg_cancellations", "between", "days_before_pickup", "warn", "days_before_pickup < 0", "days_before_pickup IS NOT NULL"),
        _row("dim_partners", "between", "commission_rate", "error", "commission_rate < 0.05e0 OR commission_rate > 0.30e0"),
        _row("fct_bookings", "between", "total_amount", "error", "total_amount < 0", "status IN ('confirmed', 'completed')"),
    ],
    "pair_greater": [
        _row("int_sessions", "pair_greater", "ended_at", "warn", "ended_at <= started_at", "ended_at IS NOT NULL"),
        _row("int_bookings", "pair_greater", "dropoff_date", "warn", "dropoff_date <= pickup_date", "dropoff_date IS NOT NULL"),
        _row("int_searches", "pair_greater", "dropoff_date", "warn", "dropoff_date < pickup_date", "dropoff_date IS NOT NULL"),
    ],
}


def _singular(model: str, check: str, column: str, failing: str, population: str) -> str:
    return _result(model, check, column, "warn", f"({failing})", "NULL", f"({population})", "(SELECT 1)")


SINGULAR = {
    "click_without_result": _singular("int_searches", "click_without_result", "partner_id_clicked", f"SELECT count(*) FROM ({CLICKS})", "SELECT count(*) FROM int_searches"),
    "long_sessions": _singular("int_sessions", "long_sessions", "ended_at", f"SELECT count(*) FROM ({LONG})", "SELECT count(*) FROM int_sessions"),
    "amount_outliers": _singular("int_bookings", "amount_outliers", "total_amount", f"SELECT count(*) FROM ({IQR})", "SELECT count(*) FROM iqr_base"),
    "refund_over_total": _singular("stg_cancellations", "refund_over_total", "refund_amount", f"SELECT coalesce(sum(copies), 0) FROM ({REFUNDS})", "SELECT count(*) FROM stg_cancellations"),
    "same_user_day": _singular("int_bookings", "same_user_day", "user_id", f"SELECT count(*) FROM ({USER_DAYS})", "SELECT count(DISTINCT user_id) FROM int_bookings"),
}
SUITE_SQL = "\nUNION ALL ".join([*(sql for kind in DQ.values() for sql in kind), *SINGULAR.values()])
EXTENDED_SQL = "\nUNION ALL ".join([
    _unique("int_sessions", "session_id"), _unique("int_bookings", "booking_id"), _unique("int_cancellations", "cancellation_id"),
    _accepted("fct_bookings", "currency", "error", "'BRL', 'USD', 'ARS', 'CLP', 'COP'"),
])

ALERTS = f"""SELECT finding, segment, {_big('failing')} AS failing_rows, {_big('total')} AS population,
  round(100e0 * failing / nullif(total, 0), 2) AS rate_pct, limit_pct,
  coalesce(100e0 * failing / nullif(total, 0) > limit_pct, false) AS breached
FROM (
  SELECT 'click_without_result' AS finding, CAST(NULL AS VARCHAR) AS segment, (SELECT count(*) FROM ({CLICKS})) AS failing, (SELECT count(*) FROM int_searches) AS total, 2e0 AS limit_pct
  UNION ALL SELECT 'long_sessions', NULL, (SELECT count(*) FROM ({LONG})), (SELECT count(*) FROM int_sessions), 1e0
  UNION ALL SELECT 'refund_over_total', NULL, (SELECT sum(copies) FROM ({REFUNDS})), (SELECT count(*) FROM stg_cancellations), 20e0
  UNION ALL SELECT 'same_user_day', NULL, (SELECT count(*) FROM ({USER_DAYS})), (SELECT count(DISTINCT user_id) FROM int_bookings), 0.5e0
  UNION ALL SELECT 'negative_days_before_pickup', NULL, count(*) FILTER (WHERE days_before_pickup < 0), count(*), 3e0 FROM stg_cancellations
  UNION ALL SELECT 'amount_outliers', b.car_category, count(*) FILTER (WHERE total_amount > limite_superior), count(*), 1e0
    FROM iqr_base b JOIN iqr i ON b.car_category = i.car_category GROUP BY b.car_category
  UNION ALL SELECT 'unknown_category', NULL, count(*) FILTER (WHERE car_category NOT IN ({_CATEGORIES})), count(*), 0e0
    FROM (SELECT car_category FROM stg_bookings UNION ALL SELECT car_category FROM stg_searches))"""


def _null_rate(model: str, column: str, expected: float) -> str:
    rate = f"100e0 * count(*) FILTER (WHERE {column} IS NULL) / count(*)"
    return f"""SELECT '{model}' AS model, '{column}' AS "column", round({rate}, 2) AS null_pct, {expected}e0 AS expected_pct,
  abs({rate} - {expected}e0) <= 3e0 AS within_tolerance FROM {model}"""


NULL_RATES = "\nUNION ALL ".join([
    _null_rate("stg_partners", "tier", 25.0), _null_rate("stg_partners", "updated_at", 33.0),
    _null_rate("stg_partners", "contact_email", 30.0), _null_rate("stg_sessions", "user_id", 12.5),
    _null_rate("stg_sessions", "ended_at", 4.0), _null_rate("stg_sessions", "utm_source", 30.0),
    _null_rate("stg_bookings", "user_id", 11.0), _null_rate("stg_bookings", "car_category", 3.0),
    _null_rate("stg_bookings", "total_amount", 1.0), _null_rate("stg_bookings", "payment_method", 25.0),
    _null_rate("stg_cancellations", "refund_amount", 10.0),
])


def _profile(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, {_big('sum(n)')} AS row_count, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
  100e0 * count(*) FILTER (WHERE n > 1) / sum(n) AS duplicated_pct,
  count(*) FILTER (WHERE n > 1 AND versions > 1) AS conflicting_keys
FROM (SELECT {key}, sum(copies) AS n, count(*) AS versions
  FROM (SELECT *, count(*) AS copies FROM raw_{table} GROUP BY ALL) GROUP BY {key})"""


def _variants(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS "column", lower(trim({column})) AS value,
  count(DISTINCT {column}) AS spellings, count(*) AS row_count FROM raw_{table} WHERE {column} IS NOT NULL
GROUP BY lower(trim({column})) HAVING count(DISTINCT {column}) > 1"""


# -- reports ----------------------------------------------------------------------------------------------------
PARTS = """earning AS (
  SELECT *, CAST(date_trunc('month', booked_at) AS DATE) AS reference_month, coalesce(total_amount > 0, false) AS ok,
    EXISTS (SELECT 1 FROM int_cancellations c WHERE c.booking_id = b.booking_id) AS cancelled
  FROM active_bookings b WHERE status IN ('confirmed', 'completed')),
flagged AS (
  SELECT *, ok AND user_id IS NOT NULL AND count(*) FILTER (WHERE ok) OVER (PARTITION BY user_id, CAST(booked_at AS DATE)) > 1 AS crowded
  FROM earning),
partner_month AS (
  SELECT partner_id, reference_month, count(*) FILTER (WHERE ok AND NOT cancelled) AS booking_count,
    count(*) FILTER (WHERE NOT ok) AS invalid, count(*) FILTER (WHERE crowded) AS suspicious
  FROM flagged GROUP BY 1, 2),
revenue AS (
  SELECT partner_id, partner_name, r.reference_month, currency, revenue_amount, r.booking_count,
    invalid AS excluded_invalid_amount_count, suspicious AS flagged_suspicious_booking_count,
    r.reference_month >= (SELECT date_trunc('month', max(booked_at)) FROM active_bookings) AS is_partial_month
  FROM (SELECT partner_id, reference_month, currency, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue_amount,
      count(*) AS booking_count FROM earning WHERE ok AND NOT cancelled GROUP BY 1, 2, 3) r
  JOIN partner_month m USING (partner_id, reference_month) JOIN dim_partners USING (partner_id))"""

RATES_TABLE = """fx AS (
  SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BRL' WHEN '2' THEN 'USD' WHEN '3' THEN 'ARS' WHEN '4' THEN 'CLP' ELSE 'COP' END AS currency,
    CAST(o_orderdate AS DATE) AS rate_date, count(*) AS n FROM orders WHERE extract(day FROM o_orderdate) % 3 = 1 GROUP BY 1, 2),
rates AS (
  SELECT currency, rate_date, CASE WHEN currency = 'BRL' THEN 1 ELSE (n % 50 + 1) / 20e0 END AS rate FROM fx)"""
FINE_RATES = RATES_TABLE.replace("END AS rate FROM fx)", "END AS coarse FROM fx)").replace("rates AS", "coarse_rates AS") + """,
rates AS (SELECT currency, rate_date, round(coarse / 97, 10) AS rate FROM coarse_rates)"""


def _fx(day: str, rates: str = RATES_TABLE) -> str:
    return _on(
        """SELECT reference_month, CAST(sum(n) AS BIGINT) AS booking_count,
  CAST(round(coalesce(sum(CAST(amount AS DECIMAL(22,2)) * CAST(rate AS DECIMAL(16,10))), 0), 2) AS DOUBLE) AS receita_total_brl,
  CAST(coalesce(sum(n) FILTER (WHERE rate IS NULL), 0) AS BIGINT) AS unconverted_bookings
FROM (SELECT d.*, r.rate FROM daily d ASOF LEFT JOIN rates r ON d.currency = r.currency AND d.rate_day >= r.rate_date)
GROUP BY reference_month""",
        rates,
        f"""daily AS (
  SELECT currency, {day} AS rate_day, CAST(date_trunc('month', booked_at) AS DATE) AS reference_month,
    sum(CAST(total_amount AS DECIMAL(18,2))) AS amount, count(*) AS n FROM standing GROUP BY 1, 2, 3)""",
    )


# -- incremental facts ------------------------------------------------------------------------------------------
def _loaded(model: str, ts: str, cut: str, first: str = "true", second: str | None = None) -> str:
    columns = second or "*"
    return _on(
        f"""SELECT * FROM first_load f WHERE NOT EXISTS (SELECT 1 FROM second_load s WHERE s.{ts} > (SELECT max({ts}) FROM first_load)
    AND s.{'booking_id' if model == 'int_bookings' else 'session_id'} = f.{'booking_id' if model == 'int_bookings' else 'session_id'})
UNION ALL SELECT * FROM second_load WHERE {ts} > (SELECT max({ts}) FROM first_load)""",
        f"first_load AS (SELECT * FROM {model} WHERE {ts} < TIMESTAMP '{cut}' AND {first})",
        f"second_load AS (SELECT {columns} FROM {model})",
    )


_NUMBER = "CAST(substr(booking_id, 4) AS BIGINT)"
_MOVES = f"booked_at < TIMESTAMP '{BOOKING_CUT}' AND {_NUMBER} % 20 = 7 AND total_amount > 0"

ORACLES: dict[str, str] = {
    **{f"stg_{t}": _on(f"SELECT * FROM stg_{t}") for t in ("partners", "sessions", "searches", "bookings", "cancellations")},
    **{f"int_{t}": _on(f"SELECT * FROM int_{t}") for t in ("partners", "sessions", "searches", "bookings", "cancellations")},
    "dim_partners": _on("SELECT * FROM dim_partners"),
    "dim_users": _on("SELECT * FROM dim_users"),
    "build_models": _on(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS model, count(*) AS row_count FROM {name}"
            for name in ("int_partners", "int_sessions", "int_searches", "int_bookings", "int_cancellations",
                         "dim_partners", "dim_users", "fct_bookings", "fct_sessions")
        )
    ),
    "fct_bookings_full": _on("SELECT * FROM fct_bookings"),
    "fct_bookings_incremental": _loaded("int_bookings", "booked_at", BOOKING_CUT),
    "fct_bookings_late_rows": _loaded("int_bookings", "booked_at", BOOKING_CUT, f"{_NUMBER} % 10 <> 3"),
    "fct_bookings_updated_rows": _loaded(
        "int_bookings", "booked_at", BOOKING_CUT,
        second=f"""* REPLACE (CASE WHEN {_MOVES} THEN TIMESTAMP '{MOVED_TO}' ELSE booked_at END AS booked_at,
    CASE WHEN {_MOVES} THEN 'completed' ELSE status END AS status)""",
    ),
    "fct_sessions_incremental": _loaded("int_sessions", "started_at", SESSION_CUT),
    "stream_fct_upsert": _loaded("int_bookings", "booked_at", BOOKING_CUT),
    "stream_burst": _on("SELECT session_id, peak AS pico_buscas_5min FROM peaks", FIXED_PEAKS),
    "funnel_by_segment": _on(FUNNEL, _flags()),
    "funnel_by_segment_confirmed": _on(FUNNEL, _flags("AND status IN ('confirmed', 'completed')")),
    "funnel_from_bitmaps": _on(FUNNEL, _flags()),
    "sessions_active_by_month": _on(
        """SELECT mes, etapa, count(DISTINCT session_id) AS sessoes FROM (
  SELECT session_id, strftime(started_at, '%Y-%m') AS mes, 'Sessões' AS etapa FROM int_sessions
  UNION ALL SELECT session_id, strftime(searched_at, '%Y-%m'), 'Buscas' FROM int_searches
  UNION ALL SELECT session_id, strftime(booked_at, '%Y-%m'), 'Reservas' FROM fct_bookings b
  WHERE NOT EXISTS (SELECT 1 FROM int_cancellations c WHERE c.booking_id = b.booking_id))
WHERE session_id IN (SELECT session_id FROM int_sessions) GROUP BY ALL"""
    ),
    "funnel_stages_long": _on(STAGES, _flags()),
    "top_partners_90d": _on(
        f"""SELECT partner_name AS parceiro, quantidade_reservas, total_brl, total_usd, total_ars, total_clp, total_cop
FROM (SELECT partner_id, count(*) AS quantidade_reservas, {_sums('total_')} FROM standing
  WHERE booked_at >= (SELECT max(booked_at) FROM fct_bookings) - INTERVAL 90 DAY GROUP BY partner_id)
JOIN dim_partners USING (partner_id) ORDER BY quantidade_reservas DESC, total_brl DESC, partner_id LIMIT 10"""
    ),
    "ltv_cohort": _cohort("%Y-%m-%d"),
    "ltv_cohort_month": _cohort("%Y-%m"),
    "monthly_evolution": _on(
        f"SELECT strftime(booked_at, '%Y-%m') AS mes_ano, count(*) AS quantidade_reservas, {_sums('receita_')} FROM standing GROUP BY 1"
    ),
    "bot_burst_fixed": _bursts(FIXED_PEAKS),
    "bot_burst_sliding": _bursts(SLIDING_PEAKS, "DISTINCT"),
    "cancellation_outliers": _outliers("2", lower=True),
    "cancellation_outliers_15": _outliers("1.5e0"),
    "cancellation_outliers_same_population": _outliers("2", same_population=True),
    "click_without_result": _on(CLICKS),
    "long_sessions": _on(LONG),
    "amount_outliers_iqr": _on(IQR, IQR_BASE),
    "amount_quartiles_sketched": _on(
        """SELECT car_category, count(*) AS n, count(*) AS summarised, true AS q1_within, true AS q3_within
FROM iqr_base GROUP BY car_category""", IQR_BASE
    ),
    "refund_over_total": _on(
        """SELECT c.cancellation_id, c.booking_id, c.refund_amount, b.total_amount
FROM stg_cancellations c JOIN stg_bookings b ON c.booking_id = b.booking_id WHERE c.refund_amount > b.total_amount"""
    ),
    "refund_over_total_counted": _on(REFUNDS),
    "same_user_day": _on(USER_DAYS),
    **{f"dq_{kind}": _on("\nUNION ALL ".join(checks)) for kind, checks in DQ.items()},
    "dq_suite": _on(SUITE_SQL, IQR_BASE),
    "dq_suite_by_loads": _on(SUITE_SQL, IQR_BASE),
    "dq_extended": _on(EXTENDED_SQL),
    "dq_thresholds": _on(ALERTS, IQR_BASE),
    "dq_null_rates": _on(NULL_RATES),
    "dq_freshness": "SELECT 3e0 * (n_nationkey + 1) AS age_hours, 3 * (n_nationkey + 1) <= 24 AS fresh FROM nation",
    "dq_trust_gate": _on(
        f"""SELECT hours <= 24 AS fresh, failed_errors, breached_limits, hours <= 24 AND failed_errors = 0 AND breached_limits = 0 AS trusted
FROM (SELECT (SELECT count(*) FROM ({SUITE_SQL}) WHERE status = 'error') AS failed_errors,
  (SELECT count(*) FROM ({ALERTS}) WHERE breached) AS breached_limits), (VALUES (0), (30)) AS v(hours)""",
        IQR_BASE,
    ),
    "dq_trust_gate_untrusted": _on(
        f"""SELECT hours <= 24 AS fresh, failed_errors, breached_limits, hours <= 24 AND failed_errors = 0 AND breached_limits = 0 AS trusted
FROM (SELECT (SELECT count(*) FROM ({SUITE_SQL}) WHERE status = 'error') AS failed_errors,
  (SELECT count(*) FROM ({ALERTS}) WHERE breached) AS breached_limits), (VALUES (23.5), (24.25)) AS v(hours)""",
        IQR_BASE,
    ).replace("dim_partners AS (SELECT * FROM int_partners)", "dim_partners AS (SELECT * FROM int_partners UNION ALL SELECT * FROM int_partners)"),
    "profile_duplicates": _on(
        "\nUNION ALL ".join(
            _profile(t, k)
            for t, k in (("partners", "partner_id"), ("sessions", "session_id"), ("searches", "search_id"),
                         ("bookings", "booking_id"), ("cancellations", "cancellation_id"))
        )
    ),
    "profile_case_variants": _on(
        "\nUNION ALL ".join(
            _variants(t, c)
            for t, c in (("sessions", "device"), ("sessions", "country"), ("partners", "status"), ("bookings", "currency"),
                         ("bookings", "status"), ("bookings", "car_category"))
        )
    ),
    "rpt_revenue_by_partner": _on("SELECT * FROM revenue", PARTS),
    "completeness_index": _on(
        """SELECT partner_id, reference_month, booking_count, invalid AS excluded_invalid_amount_count,
  round(100e0 * invalid / (booking_count + invalid), 2) AS invalid_pct, 100e0 * invalid / (booking_count + invalid) > 2 AS alert
FROM partner_month WHERE booking_count + invalid > 0""",
        PARTS,
    ),
    "invalid_amount_run": _on(
        """SELECT booking_count, invalid AS excluded_invalid_amount_count,
  round(100e0 * invalid / nullif(booking_count + invalid, 0), 2) AS invalid_pct,
  coalesce(100e0 * invalid / nullif(booking_count + invalid, 0) > 2, false) AS alert
FROM (SELECT CAST(coalesce(sum(booking_count), 0) AS BIGINT) AS booking_count, CAST(coalesce(sum(invalid), 0) AS BIGINT) AS invalid FROM partner_month)""",
        PARTS,
    ),
    "rpt_contract_violations": _on(
        """SELECT 'not_null' AS rule, field, CASE WHEN field = 'partner_name' THEN (SELECT count(*) FROM revenue WHERE currency = 'USD') ELSE 0 END AS failing_rows
FROM (VALUES ('partner_id'), ('partner_name'), ('reference_month'), ('currency'), ('revenue_amount'), ('booking_count'),
  ('excluded_invalid_amount_count'), ('flagged_suspicious_booking_count'), ('is_partial_month')) AS v(field)
UNION ALL SELECT 'unique', 'partner_id, reference_month, currency', (SELECT 2 * count(*) FROM revenue WHERE currency = 'BRL')""",
        PARTS,
    ),
    "suspicious_bookings": _on(
        """SELECT partner_id, CAST(date_trunc('month', booked_at) AS DATE) AS reference_month, booking_id, user_id,
  CAST(booked_at AS DATE) AS booked_date, bookings_on_day, currency, total_amount
FROM (SELECT *, count(*) OVER (PARTITION BY user_id, CAST(booked_at AS DATE)) AS bookings_on_day FROM fct_bookings
  WHERE status IN ('confirmed', 'completed') AND total_amount > 0 AND user_id IS NOT NULL) WHERE bookings_on_day > 1"""
    ),
    "suspicious_rate": _on(
        """SELECT flagged_bookings, users_with_booking, round(100e0 * flagged_bookings / nullif(users_with_booking, 0), 2) AS suspicious_pct,
  coalesce(100e0 * flagged_bookings / nullif(users_with_booking, 0) > 0.5, false) AS alert
FROM (SELECT (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM int_bookings
    WHERE user_id IS NOT NULL AND status IN ('confirmed', 'completed') GROUP BY user_id, CAST(booked_at AS DATE) HAVING count(*) > 1)) AS flagged_bookings,
  (SELECT count(DISTINCT user_id) FROM int_bookings) AS users_with_booking)"""
    ),
    "currency_domain_check": _on(_accepted("fct_bookings", "currency", "error", "'BRL', 'USD', 'ARS', 'CLP'")),
    "net_revenue": _on(
        """SELECT partner_id, reference_month, currency, booking_count, CAST(gross AS DOUBLE) AS gross_amount,
  CAST(refund AS DOUBLE) AS refund_amount, CAST(gross - refund AS DOUBLE) AS revenue_amount_net_of_refund
FROM (SELECT partner_id, CAST(date_trunc('month', booked_at) AS DATE) AS reference_month, currency, count(*) AS booking_count,
    sum(CAST(total_amount AS DECIMAL(18,2))) AS gross, coalesce(sum(r), 0) AS refund
  FROM fct_bookings LEFT JOIN (SELECT booking_id, sum(CAST(refund_amount AS DECIMAL(18,2))) AS r FROM int_cancellations GROUP BY 1) USING (booking_id)
  WHERE status IN ('confirmed', 'completed') GROUP BY 1, 2, 3)"""
    ),
    "fx_revenue_asof": _fx("CAST(booked_at AS DATE)"),
    "fx_revenue_month_close": _fx("last_day(CAST(booked_at AS DATE))"),
    "fx_fine_rates": _fx("CAST(booked_at AS DATE)", FINE_RATES),
    "asof_event_times": """SELECT event_id, v AS latest FROM (
  SELECT event_id, user_id % 50 AS k, ts - INTERVAL 500 MILLISECOND AS t FROM events) p
ASOF LEFT JOIN (SELECT user_id % 50 AS k, ts AS at, max(value) AS v FROM (
  SELECT user_id, ts, value FROM events WHERE event_type = 'error'
  UNION ALL SELECT user_id, ts, value / 2 FROM events WHERE event_type = 'error') GROUP BY 1, 2) f ON p.k = f.k AND p.t >= f.at""",
    "asof_skewed_times": """SELECT event_id, v AS latest FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 50 END AS k, TIMESTAMP '2024-01-01' + to_microseconds(event_id % 4000000) AS t FROM events) p
ASOF LEFT JOIN (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 50 END AS k, TIMESTAMP '2024-01-01' + to_microseconds(event_id % 4000000) AS at, max(value) AS v
  FROM events WHERE event_type = 'error' GROUP BY 1, 2) f ON p.k = f.k AND p.t >= f.at""",
    "lines_above_orders": """WITH l AS (SELECT l_orderkey % 3 AS k, l_extendedprice AS v, 1 AS l, 0 AS r FROM lineitem
  UNION ALL SELECT o_orderkey % 3, o_totalprice, 0, 1 FROM orders)
SELECT k, sum(l * below)::BIGINT AS pairs FROM (
  SELECT k, l, coalesce(sum(r) OVER (PARTITION BY k ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS below FROM l)
GROUP BY k HAVING sum(l * below) > 0""",
    "refund_over_total_by_booking": _on(f"SELECT booking_id, {_big('sum(copies)')} AS pairs FROM ({REFUNDS}) GROUP BY booking_id"),
    "rpt_refreshed": _on("SELECT * FROM revenue", PARTS),
    "fct_changes": _on(
        f"""SELECT booking_id, status, booked_at, CASE WHEN {_NUMBER} % 10 = 3 THEN 'inserted' ELSE 'updated' END AS change,
  CASE WHEN {_NUMBER} % 10 <> 3 THEN booked_at - INTERVAL 1 HOUR END AS was
FROM active_bookings WHERE month(booked_at) % 3 = 0 AND ({_NUMBER} % 10 = 3 OR {_NUMBER} % 20 = 7)"""
    ),
    "fct_random_keys": _on(
        f"""SELECT sha256(booking_id) AS booking_key, booking_id,
  CASE WHEN booked_at < TIMESTAMP '{BOOKING_CUT}' AND {_NUMBER} % 50 = 1 THEN TIMESTAMP '{MOVED_TO}' ELSE booked_at END AS booked_at, status FROM int_bookings"""
    ),
    "stream_fct_unordered": _on("SELECT * FROM int_bookings"),
    "stream_burst_sliding": _on("SELECT session_id, peak FROM peaks", SLIDING_PEAKS),
    "stream_newest_bookings": _on("SELECT * FROM int_bookings"),
    "stream_int_searches": _on("SELECT * FROM int_searches"),
    "fct_lookback_late": _on(
        """SELECT * EXCLUDE (late) REPLACE (CASE WHEN late THEN booked_at - INTERVAL 1 DAY ELSE booked_at END AS booked_at,
    CASE WHEN late THEN 'late' ELSE status END AS status)
FROM (SELECT *, CAST(substr(booking_id, 4) AS BIGINT) % 10 = 3 AS late FROM int_bookings)"""
    ),
    "csv_round_trip": _on("SELECT * FROM stg_bookings"),
    **{f"csv_round_trip_{t}": _on(f"SELECT * FROM stg_{t}") for t in ("partners", "sessions", "searches", "cancellations")},
    "parquet_marts_read": _on("SELECT booking_id, partner_name, total_amount FROM fct_bookings JOIN dim_partners USING (partner_id)"),
    "csv_export_uncapped": _on("SELECT booking_id, currency, status FROM fct_bookings"),
    "month_close_export": _on(
        "SELECT partner_id, currency, booking_count, reference_month FROM revenue WHERE NOT is_partial_month", PARTS
    ),
    "event_outliers_null_group": """SELECT event_id, e.event_type, value, round(upper_limit, 6) AS upper_limit
FROM (SELECT event_id, nullif(event_type, 'view') AS event_type, value FROM events) e JOIN (
  SELECT event_type, q3 + 1.5 * (q3 - q1) AS upper_limit FROM (
    SELECT nullif(event_type, 'view') AS event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)) q
ON e.event_type IS NOT DISTINCT FROM q.event_type WHERE value > upper_limit""",
    "quantiles_infinite": """SELECT l_returnflag, round(quantile_cont(p, 0.5), 6) AS q_0, round(quantile_cont(p, 0.9), 6) AS q_1,
  round(quantile_cont(p, 1.0), 6) AS q_2
FROM (SELECT l_returnflag, CASE WHEN l_quantity > 48 THEN CAST('inf' AS DOUBLE) ELSE l_extendedprice END AS p FROM lineitem) GROUP BY 1""",
    "pii_keyed_export": _on("SELECT * REPLACE (sha256('registered' || user_id) AS user_id) FROM fct_bookings"),
    "asof_booking_rate": _on(
        """SELECT b.booking_id, b.currency, CAST(b.booked_at AS DATE) AS booked_date, CAST(r.rate AS DOUBLE) AS rate
FROM fct_bookings b ASOF LEFT JOIN rates r ON b.currency = r.currency AND CAST(b.booked_at AS DATE) >= r.rate_date""",
        RATES_TABLE,
    ),
    "avg_ticket": _on(
        """SELECT currency, count(total_amount) AS quantidade_reservas,
  round(CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / count(total_amount), 2) AS ticket_medio
FROM fct_bookings WHERE status IN ('confirmed', 'completed') GROUP BY currency"""
    ),
    "scorecards": _on(
        """SELECT 'reservas_validas' AS indicador, CAST(count(*) AS DOUBLE) AS valor FROM standing
UNION ALL SELECT 'receita_brl', CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE currency = 'BRL'), 0) AS DOUBLE) FROM standing
UNION ALL SELECT 'conversao_geral_pct', round(100e0 * count(*) FILTER (WHERE booked) / count(*), 2) FROM flags
UNION ALL SELECT 'taxa_media_cancelamento_pct', round(avg(taxa), 2) FROM rates""",
        _flags(),
        _rates(),
    ),
    "sql_monthly_evolution": _on(
        "SELECT strftime(booked_at, '%Y-%m') AS mes_ano, count(*) AS quantidade_reservas FROM standing GROUP BY 1"
    ),
    "sql_burst_counts": _on(
        """SELECT time_bucket(INTERVAL 7 MINUTE, searched_at) AS bucket, count(*) AS searches,
  max(date_diff('hour', started_at, searched_at)) AS latest_hour
FROM stg_searches q JOIN fct_sessions s ON q.session_id = s.session_id GROUP BY 1"""
    ),
    "revenue_mom_change": _on(
        """SELECT r.partner_id, r.currency, r.reference_month, r.revenue_amount, p.revenue_amount AS previous_amount,
  round(100e0 * (r.revenue_amount - p.revenue_amount) / nullif(p.revenue_amount, 0), 2) + 0e0 AS change_pct
FROM revenue r LEFT JOIN revenue p ON p.partner_id = r.partner_id AND p.currency = r.currency
  AND p.reference_month + INTERVAL 1 MONTH = r.reference_month""",
        PARTS,
    ),
    "pii_masked_export": _on("SELECT * REPLACE (sha256(user_id) AS user_id) FROM fct_bookings"),
    "pii_masked_partners": _on("SELECT * REPLACE (sha256(contact_email) AS contact_email) FROM dim_partners"),
    "pii_dropped_sessions": _on("SELECT * EXCLUDE (user_id) FROM fct_sessions"),
    "latest_line": """SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC""",
    "revenue_by_flag": "SELECT l_linestatus, count(*) AS line_count, "
    + ", ".join(
        f"CAST(sum(CASE WHEN l_returnflag = '{f}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total_{f.lower()}"
        for f in "ANR"
    )
    + " FROM lineitem GROUP BY l_linestatus",
    "event_outliers": """SELECT event_id, e.event_type, value, round(upper_limit, 6) AS upper_limit FROM events e JOIN (
  SELECT event_type, q3 + 1.5 * (q3 - q1) AS upper_limit FROM (
    SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)) l
ON e.event_type = l.event_type WHERE value > upper_limit""",
    "price_quantiles": """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS q_0,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q_1, round(quantile_cont(l_extendedprice, 0.95), 6) AS q_2
FROM lineitem GROUP BY l_returnflag""",
    "event_bursts": """SELECT user_id, max(n) AS peak FROM (
  SELECT user_id, time_bucket(INTERVAL 7 DAY, ts) AS b, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1 HAVING max(n) > 1""",
    "event_bursts_sliding": """SELECT user_id, max(n) AS peak FROM (
  SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT)
    RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS n FROM events) GROUP BY 1 HAVING max(n) > 1""",
    "events_per_bucket": "SELECT time_bucket(INTERVAL 7 MINUTE, ts) AS bucket_start, count(*) AS events FROM events GROUP BY 1",
}

# A reader export holds what its query gives.
ORACLES |= {
    "export_funnel_by_segment": ORACLES["funnel_by_segment"],
    "export_funnel_stages": ORACLES["funnel_stages_long"],
    "export_top_partners": ORACLES["top_partners_90d"],
    "export_ltv_cohort": ORACLES["ltv_cohort_month"],
    "export_cancellation_outliers": _outliers("2"),
    "export_monthly_evolution": ORACLES["monthly_evolution"],
}
