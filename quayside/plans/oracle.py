"""DuckDB SQL that states each registered query independently of Spark.

The raw feeds come from the shared adapter text (``fixtures.cte``); the rest is
plain SQL: QUALIFY row_number() for dedupe, trim() with Python's whitespace
set for ``clean``, CASE for the boolean grammar.
"""

from __future__ import annotations

from quayside.functions.cleaning import WHITESPACE
from quayside.sources.fixtures import ADAPTERS

WS = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def clean(x: str) -> str:
    return f"NULLIF(trim(CAST({x} AS VARCHAR), {WS}), '')"


def lower_clean(x: str) -> str:
    return f"lower({clean(x)})"


def upper_or_empty(x: str) -> str:
    return f"upper(COALESCE({clean(x)}, ''))"


def parse_bool(x: str) -> str:
    v = lower_clean(x)
    return (f"(CASE WHEN {v} IS NULL THEN NULL WHEN {v} IN ('true','1','yes') THEN true "
            f"WHEN {v} IN ('false','0','no') THEN false ELSE error('invalid boolean') END)")


def num(x: str, t: str) -> str:
    return f"CAST({clean(x)} AS {t})"


# Curated CTE bodies, in dependency order.
CURATED = {
    "ev_dd": "SELECT * FROM raw_events QUALIFY row_number() OVER "
             "(PARTITION BY event_id ORDER BY ingest_date DESC, _seq DESC) = 1",
    "ev_all": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {lower_clean('event_type')} AS event_type,
        session_id, {clean('user_id')} AS user_id, CAST(event_ts AS TIMESTAMP) AS event_ts,
        {clean('page')} AS page, {clean('partner_id')} AS partner_id, {lower_clean('device')} AS device,
        {upper_or_empty('country')} AS country, {clean('channel')} AS channel,
        {num('price_usd', 'DOUBLE')} AS price_usd, {clean('metadata_json')} AS metadata_json,
        {parse_bool('is_bot_flag')} AS is_bot_flag, CAST(ingest_date AS DATE) AS ingest_date FROM ev_dd""",
    "ev_good": "SELECT * FROM ev_all WHERE NOT COALESCE(is_bot_flag, false)",
    "ev_bots": "SELECT * FROM ev_all WHERE COALESCE(is_bot_flag, false)",
    "tx_dd": "SELECT * FROM raw_transactions QUALIFY row_number() OVER "
             "(PARTITION BY transaction_id ORDER BY ingest_ts DESC, _seq DESC) = 1",
    "tx_all": f"""SELECT transaction_id, booking_ref, partner_id, user_id,
        CAST(created_at AS TIMESTAMP) AS created_at, CAST(ingest_ts AS TIMESTAMP) AS ingest_ts,
        {num('amount', 'DECIMAL(18,2)')} AS amount, upper(currency) AS currency,
        {lower_clean('status')} AS status, payment_method, gateway,
        {num('retry_count', 'INTEGER')} AS retry_count, error_code, notes,
        {num('processing_ms', 'INTEGER')} AS processing_ms, CAST(ingest_ts AS DATE) AS ingest_date,
        (CAST(ingest_ts AS TIMESTAMP) - CAST(created_at AS TIMESTAMP)) > INTERVAL 7 DAY AS is_late
        FROM tx_dd""",
    "tx_good": "SELECT * FROM tx_all WHERE NOT COALESCE(amount < 0, false)",
    "tx_quarantine": "SELECT *, 'negative_amount' AS quarantine_reason FROM tx_all WHERE COALESCE(amount < 0, false)",
    "pt_norm": f"""SELECT _seq, partner_id, {lower_clean('schema_version')} AS schema_version, name,
        {upper_or_empty('country_code')} AS country_code, {lower_clean('status')} AS status,
        {lower_clean('tier')} AS tier, {num('commission_rate', 'DECIMAL(8,6)')} AS commission_rate,
        CAST(created_at AS TIMESTAMP) AS created_at, CAST({clean('updated_at')} AS TIMESTAMP) AS updated_at,
        {num('sla_hours', 'INTEGER')} AS sla_hours, {num('avg_rating', 'DOUBLE')} AS avg_rating,
        {clean('api_endpoint')} AS api_endpoint, {parse_bool('webhook_enabled')} AS webhook_enabled
        FROM raw_partner_catalog""",
    "pt_all": """SELECT partner_id, schema_version, name, country_code, status, tier, commission_rate,
        created_at, updated_at, sla_hours, avg_rating, api_endpoint, webhook_enabled FROM pt_norm
        QUALIFY row_number() OVER (PARTITION BY partner_id, schema_version, updated_at
          ORDER BY COALESCE(updated_at, created_at) DESC, _seq DESC) = 1""",
    "pm_dd": "SELECT * FROM raw_payment_stream QUALIFY row_number() OVER (PARTITION BY event_id "
             "ORDER BY CAST(kafka_partition AS INTEGER) DESC, CAST(kafka_offset AS BIGINT) DESC) = 1",
    "pm_all": f"""SELECT event_id, event_type, transaction_id, user_id, partner_id,
        {num('amount', 'DECIMAL(18,2)')} AS amount, currency, {lower_clean('status')} AS status, gateway,
        CAST(event_ts AS TIMESTAMP) AS event_ts, {num('kafka_partition', 'INTEGER')} AS kafka_partition,
        {num('kafka_offset', 'BIGINT')} AS kafka_offset, {num('processing_lag_ms', 'BIGINT')} AS processing_lag_ms,
        {parse_bool('is_spike')} AS is_spike, CAST(event_ts AS DATE) AS event_date FROM pm_dd""",
}

NEEDS = {
    "ev_dd": ["raw_events"], "ev_all": ["ev_dd"], "ev_good": ["ev_all"], "ev_bots": ["ev_all"],
    "tx_dd": ["raw_transactions"], "tx_all": ["tx_dd"], "tx_good": ["tx_all"], "tx_quarantine": ["tx_all"],
    "pt_norm": ["raw_partner_catalog"], "pt_all": ["pt_norm"],
    "pm_dd": ["raw_payment_stream"], "pm_all": ["pm_dd"],
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in NEEDS.get(n, []):
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(names, extra: dict | None = None) -> str:
    """``WITH`` clause holding the named adapter / curated CTEs (and deps),
    followed by ``extra`` CTEs in the given order."""
    parts = []
    for n in _order(names):
        body = ADAPTERS.get(n) or CURATED[n]
        parts.append(f"{n} AS ({body})")
    for n, body in (extra or {}).items():
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
