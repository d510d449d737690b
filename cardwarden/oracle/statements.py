"""One DuckDB statement per query."""

from __future__ import annotations

from cardwarden.catalog import EXTREMES, QUANTILES
from cardwarden.fixtures import FIXTURE_POLICY
from cardwarden.oracle import tables as t
from cardwarden.policy import Levels, RiskPolicy, Tiers


def _events(select: str, *more: str) -> str:
    return "WITH " + ",".join([t.EVENTS, t.FEATURES, t.CATEGORIES, *more]) + "\n" + select


def _lineitem(select: str, *more: str) -> str:
    return "WITH " + ",".join([t.LINEITEM, t.FEATURES, *more]) + "\n" + select


# Rules -----------------------------------------------------------------------------------


def _tiers(column: str, tiers: Tiers) -> str:
    cases = " ".join(f"WHEN {column} > {bound} THEN {points}" for bound, points in tiers)
    return f"CAST(CASE {cases} ELSE 0 END AS DOUBLE)"


def _levels(column: str, levels: Levels, floor: str) -> str:
    cases = " ".join(f"WHEN {column} >= {bound} THEN '{label}'" for bound, label in levels)
    return f"CASE {cases} ELSE '{floor}' END"


def _flagged(p: RiskPolicy) -> str:
    return f"""
met AS (
  SELECT *, tx_count > {p.day_transactions} AS crit_volume, city_count > {p.day_cities} AS crit_cities,
    coalesce(day_amount > {p.day_amount}, false) AS crit_amount
  FROM daily
),
flagged AS (
  SELECT *, {_levels('criteria_count', p.alert_levels, p.alert_floor)} AS alert_level
  FROM (SELECT *, CAST(crit_volume AS INTEGER) + CAST(crit_cities AS INTEGER)
          + CAST(crit_amount AS INTEGER) AS criteria_count
        FROM met WHERE crit_volume OR crit_cities OR crit_amount) m
)"""


def _scores(p: RiskPolicy) -> str:
    return f"""
scores AS (
  SELECT *, {_levels('risk_score', p.score_levels, p.score_floor)} AS risk_level
  FROM (SELECT *, score_volume + score_geo + score_amount + score_error AS risk_score
    FROM (SELECT *, {_tiers('tx_per_active_day', p.volume_tiers)} AS score_volume,
            {_tiers('city_count', p.city_tiers)} AS score_geo,
            {_tiers('amount_max', p.amount_tiers)} AS score_amount,
            {_tiers('error_rate', p.error_tiers)} AS score_error
          FROM card_features) f) g
)"""


_LEXICAL_MAX = """CASE WHEN bool_or(alert_level = 'HIGH') THEN 'HIGH'
  WHEN bool_or(alert_level = 'MODERATE') THEN 'MODERATE' ELSE 'CRITICAL' END"""


def _top_suspicious(p: RiskPolicy, worst: str) -> str:
    return _events(
        f"""SELECT card_id, count(*) AS suspicious_days, CAST(sum(tx_count) AS BIGINT) AS suspicious_tx,
  CAST(sum(day_exact) AS DOUBLE) AS suspicious_amount, {worst} AS risk_level_max,
  avg(criteria_count) AS avg_criteria
FROM flagged GROUP BY card_id
ORDER BY suspicious_days DESC, suspicious_amount DESC, card_id LIMIT {p.top_suspicious}""",
        t.DAILY,
        _flagged(p),
    )


_FLAGGED_COLUMNS = """card_id, tx_day, tx_count, city_count, day_amount, crit_volume, crit_cities,
  crit_amount, criteria_count, alert_level"""

_SEGMENTS = """
segments AS (
  SELECT CASE WHEN s.card_id IS NULL THEN 'NORMAL' ELSE 'SUSPECT' END AS segment, count(*) AS tx_count,
    CAST(sum(exact_amount) AS DOUBLE) / count(exact_amount) AS mean_amount,
    round(stddev_samp(amount_num), 6) AS stddev_amount,
    count(DISTINCT merchant_city) AS city_count,
    count(*) FILTER (WHERE has_error) / count(*) * 100 AS error_rate,
    count(*) / nullif(count(DISTINCT tx_day), 0) AS tx_per_day
  FROM tx LEFT JOIN (SELECT card_id FROM scores WHERE risk_score >= {bound}) s
    ON tx.card_id = s.card_id
  GROUP BY 1
)"""

_SEGMENT_ROWS = """
SELECT n.segment, coalesce(tx_count, 0) AS tx_count, mean_amount, stddev_amount,
  coalesce(city_count, 0) AS city_count, error_rate, tx_per_day
FROM (VALUES ('SUSPECT'), ('NORMAL')) n(segment) LEFT JOIN segments s ON n.segment = s.segment"""

_VOLUMETRY = """
  count(*) AS transactions,
  (SELECT count(*) FROM (SELECT DISTINCT id FROM users) u) AS users,
  (SELECT count(*) FROM (SELECT DISTINCT id FROM cards) c) AS cards,
  (SELECT count(*) FROM (SELECT DISTINCT merchant_id FROM tx) m) AS merchants"""


def _rule_statements(p: RiskPolicy) -> dict[str, str]:
    days = (t.DAILY, _flagged(p))
    cards = (t.CARD_FEATURES, _scores(p))
    level_max = _levels("max(criteria_count)", p.alert_levels, p.alert_floor)
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(p.level_names))
    bound = p.high_risk_score
    return {
        "suspicious_card_days": _events(f"SELECT {_FLAGGED_COLUMNS} FROM flagged", *days),
        "alerts_by_criterion": _events(
            """SELECT count(*) FILTER (WHERE crit_volume) AS crit_volume,
  count(*) FILTER (WHERE crit_cities) AS crit_cities,
  count(*) FILTER (WHERE crit_amount) AS crit_amount FROM flagged""",
            *days,
        ),
        "alerts_by_level": _events(
            """SELECT alert_level,
  count(DISTINCT (card_id, tx_day)) AS suspicious_days, count(DISTINCT card_id) AS card_count
FROM flagged GROUP BY alert_level""",
            *days,
        ),
        "top_suspicious_cards": _top_suspicious(p, level_max),
        "top_suspicious_cards_lexical": _top_suspicious(p, _LEXICAL_MAX),
        "card_risk_score": _events("SELECT * FROM scores", *cards),
        "risk_distribution": _events(
            "SELECT risk_level, count(*) AS card_count FROM scores GROUP BY risk_level", *cards
        ),
        "high_risk_cards": _events(
            f"SELECT card_id FROM scores WHERE risk_score >= {bound}", *cards
        ),
        "suspect_transactions": _events(
            f"SELECT {_RAW} FROM raw WHERE card_id IN (SELECT card_id FROM scores WHERE risk_score >= {bound})",
            *cards,
        ),
        "normal_transactions": _events(
            f"""SELECT {_RAW} FROM raw WHERE NOT EXISTS
  (SELECT 1 FROM scores s WHERE s.card_id = raw.card_id AND risk_score >= {bound})""",
            *cards,
        ),
        "segment_comparison": _events(_SEGMENT_ROWS, *cards, _SEGMENTS.format(bound=bound)),
        "summary": _events(
            f"""SELECT {_VOLUMETRY},
  (SELECT count(*) FROM scores WHERE risk_score >= {bound}) AS high_risk_cards,
  (SELECT count(*) FROM scores) AS scored_cards,
  round((SELECT count(*) FROM scores WHERE risk_score >= {bound})
    / (SELECT count(*) FROM scores) * 100, 2) AS high_risk_pct
FROM tx""",
            *cards,
        ),
        "dark_web_cards": _events(
            f"""SELECT s.card_id, risk_score, risk_level, coalesce(dark, false) AS on_dark_web,
  CASE WHEN coalesce(dark, false) THEN '{p.level_names[0]}' ELSE risk_level END AS final_level
FROM scores s LEFT JOIN (SELECT id, bool_or(card_on_dark_web = 'Yes') AS dark FROM cards GROUP BY id) c
  ON s.card_id = c.id""",
            *cards,
        ),
        "fraud_label_eval": _events(
            f"""SELECT risk_level, labelled_tx, fraud_tx, tp AS true_positive,
  predicted - tp AS false_positive, all_fraud - tp AS false_negative,
  all_tx - predicted - (all_fraud - tp) AS true_negative,
  tp / nullif(predicted, 0) AS precision, tp / nullif(all_fraud, 0) AS recall
FROM (
  SELECT l.risk_level, l.rank, coalesce(n, 0) AS labelled_tx, coalesce(fraud, 0) AS fraud_tx,
    CAST(sum(coalesce(fraud, 0)) OVER (ORDER BY l.rank) AS BIGINT) AS tp,
    CAST(sum(coalesce(n, 0)) OVER (ORDER BY l.rank) AS BIGINT) AS predicted,
    CAST(sum(coalesce(fraud, 0)) OVER () AS BIGINT) AS all_fraud,
    CAST(sum(coalesce(n, 0)) OVER () AS BIGINT) AS all_tx
  FROM (VALUES {names}) l(rank, risk_level)
  LEFT JOIN (
    SELECT risk_level, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS fraud
    FROM tx JOIN labels ON tx.id = transaction_id JOIN scores s ON s.card_id = tx.card_id
    GROUP BY risk_level) g ON g.risk_level = l.risk_level) x""",
            *cards,
        ),
    }


# Plain statements ------------------------------------------------------------------------

_RATE = "count(*) FILTER (WHERE has_error) / count(*) * 100"
_COUNTS = f"""count(*) AS total_transactions, count(*) FILTER (WHERE has_error) AS error_count,
  {_RATE} AS error_rate"""
_RATIO = f"""count(*) AS total_transactions,
  count(*) FILTER (WHERE has_error) AS transactions_with_error, {_RATE} AS error_pct"""
_MEAN = "CAST(sum(exact_amount) AS DOUBLE) / count(exact_amount)"
_TOTAL = "CAST(sum(exact_amount) AS DOUBLE)"
_BUCKET = """CASE WHEN exact_amount < 10 THEN '<10' WHEN exact_amount <= 50 THEN '10-50'
  WHEN exact_amount <= 200 THEN '50-200' ELSE '>200' END"""
_NIGHT = """count(*) AS tx_count, count(*) FILTER (WHERE tx_hour < 5) AS night_count,
  count(*) FILTER (WHERE tx_hour < 5) / count(*) * 100 AS night_pct,
  count(*) FILTER (WHERE tx_hour < 5 AND exact_amount > 200) AS night_high_count"""
_CLIENT = f"""SELECT c.client_id, {_COUNTS}, count(DISTINCT tx.card_id) AS card_count
FROM tx LEFT JOIN cards c ON tx.card_id = c.id GROUP BY c.client_id HAVING count(*) >= 10"""
_CATEGORY = f"""SELECT merchant_category, {_COUNTS} FROM tc WHERE merchant_category IS NOT NULL
GROUP BY merchant_category HAVING count(*) >= 50"""
_SHARE = "{0} / CAST(sum({0}) OVER () AS BIGINT) * 100"
_RAW = "id, date, client_id, card_id, amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors"

_ENRICHED = f"{_RAW}, amount_num, tx_hour, tx_weekday, tx_month, tx_day, has_error, merchant_category"


def _columns_report(name: str, columns: dict[str, str]) -> str:
    rows = [
        f"SELECT '{name}' AS table_name, {i} AS position, '{c}' AS column_name, '{kind}' AS column_type,"
        f" count(*) AS row_count, count({c}) AS filled_count FROM {'raw' if name == 'transactions' else 'codes' if name == 'mcc_codes' else name}"
        for i, (c, kind) in enumerate(columns.items(), start=1)
    ]
    return "\nUNION ALL ".join(rows)


_REPORT = {
    "transactions": {
        "id": "bigint", "date": "timestamp_ntz", "client_id": "bigint", "card_id": "bigint",
        "amount": "string", "use_chip": "string", "merchant_id": "bigint",
        "merchant_city": "string", "merchant_state": "string", "zip": "string", "mcc": "int",
        "errors": "string",
    },
    "cards": {
        "id": "bigint", "client_id": "bigint", "card_number": "string", "expires": "string",
        "cvv": "string", "has_chip": "string", "credit_limit": "string",
        "acct_open_date": "string", "year_pin_last_changed": "int", "card_on_dark_web": "string",
    },
    "users": {
        "id": "bigint", "current_age": "int", "latitude": "double", "longitude": "double",
        "per_capita_income": "string", "yearly_income": "string", "total_debt": "string",
        "credit_score": "int",
    },
    "mcc_codes": {"mcc": "string", "merchant_category": "string"},
}

_DISTANCE = """2 * 6371.0 * asin(sqrt(least(
    pow(sin((radians(latitude) - radians(p_lat)) / 2), 2)
    + cos(radians(p_lat)) * cos(radians(latitude))
      * pow(sin((radians(longitude) - radians(p_lon)) / 2), 2), 1.0)))"""


def _plain_statements() -> dict[str, str]:
    null_rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
        f" count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 AS null_pct FROM raw"
        for c in _RAW.split(", ")
    )
    selects = {
        "schema_report": "\nUNION ALL ".join(_columns_report(n, c) for n, c in _REPORT.items()),
        "volumetry": f"SELECT {_VOLUMETRY} FROM tx",
        "transaction_profile": f"""SELECT count(*) AS transactions,
  (SELECT count(*) FROM (SELECT DISTINCT merchant_id FROM tx) m) AS merchants,
  count(*) FILTER (WHERE exact_amount <= 0) AS non_positive_count,
  count(*) FILTER (WHERE mcc IS NULL) AS missing_mcc_count, {_RATIO[_RATIO.index('count(*) FILTER'):]},
  {_MEAN} AS mean_amount, min(amount_num) AS min_amount, max(amount_num) AS max_amount FROM tx""",
        "null_counts": null_rows,
        "clean_amounts": "SELECT id, amount, amount_num FROM tx",
        "non_positive_amounts": "SELECT count(*) AS non_positive_count FROM tx WHERE exact_amount <= 0",
        "missing_mcc": "SELECT count(*) AS missing_mcc_count FROM tx WHERE mcc IS NULL",
        **dict.fromkeys(("amount_stats", "amount_stats_exact"), f"""SELECT {_MEAN} AS mean_amount, min(amount_num) AS min_amount,
  max(amount_num) AS max_amount, CAST(quantile_disc(exact_amount, 0.5) AS DOUBLE) AS median_amount FROM tx"""),
        "amount_stats_approximate": f"""SELECT {_MEAN} AS mean_amount, min(amount_num) AS min_amount,
  max(amount_num) AS max_amount, true AS median_within FROM tx""",
        "amount_quantiles": f"""SELECT q AS quantile, (SELECT count(exact_amount) FROM tx) AS amount_count, true AS within
FROM (SELECT unnest([{', '.join(f'{q}::DOUBLE' for q in QUANTILES)}]) AS q) quantiles""",
        "extreme_amount_totals": f"""SELECT CAST(kind AS INTEGER) AS kind, count(*) AS amount_count,
  format('{{:.9e}}', CAST(sum(amount) AS DOUBLE)) AS amount_total, max(amount) AS amount_max
FROM (SELECT CASE WHEN id % 1000 < {len(EXTREMES)} THEN id % 1000 ELSE -1 END AS kind,
    coalesce(CAST(replace([{', '.join(f"'{x}'" for x in EXTREMES)}][id % 1000 + 1], '$', '') AS DOUBLE), amount_num) AS amount
  FROM tx) x WHERE amount IS NOT NULL GROUP BY kind""",
        "fraud_label_conflicts": """SELECT transaction_id,
  is_fraud OR transaction_id % 7 = 0 AS is_fraud FROM labels""",
        "amount_buckets": f"""SELECT {_BUCKET} AS amount_bucket, count(*) AS tx_count FROM tx
WHERE exact_amount IS NOT NULL GROUP BY 1""",
        "time_features": "SELECT id, date, tx_hour, tx_weekday, tx_month FROM tx",
        "tx_by_hour": "SELECT tx_hour, count(*) AS tx_count FROM tx GROUP BY tx_hour",
        "tx_by_weekday": """SELECT tx_weekday, dayname(min(date)) AS weekday_name, count(*) AS tx_count
FROM tx GROUP BY tx_weekday""",
        "enriched_transactions": f"SELECT {_ENRICHED} FROM tc",
        "enriched_sample": f"SELECT {_ENRICHED} FROM tc ORDER BY id LIMIT {RiskPolicy().sample_rows}",
        "enriched_sample_fixture_policy": f"SELECT {_ENRICHED} FROM tc ORDER BY id LIMIT {FIXTURE_POLICY.sample_rows}",
        "top_categories": """SELECT merchant_category, count(*) AS tx_count FROM tc GROUP BY 1
ORDER BY tx_count DESC, merchant_category NULLS FIRST LIMIT 10""",
        "avg_amount_by_category": f"""SELECT merchant_category, {_MEAN} AS mean_amount, count(*) AS tx_count
FROM tc WHERE exact_amount IS NOT NULL AND merchant_category IS NOT NULL GROUP BY 1""",
        "tx_per_card_day": "SELECT card_id, tx_day, count(*) AS tx_count FROM tx GROUP BY ALL",
        "amount_per_card_day": f"""SELECT card_id, tx_day, {_TOTAL} AS amount_total, count(*) AS tx_count
FROM tx WHERE exact_amount IS NOT NULL GROUP BY card_id, tx_day""",
        "cities_per_card": """SELECT card_id, count(DISTINCT merchant_city) AS city_count, count(*) AS tx_count
FROM tx WHERE merchant_city IS NOT NULL GROUP BY card_id""",
        "error_ratio_global": f"SELECT {_RATIO} FROM tx",
        "error_ratio_by_card": f"SELECT card_id, {_RATIO} FROM tx GROUP BY card_id HAVING count(*) >= 10",
        "error_transactions": f"""SELECT count(*) FILTER (WHERE has_error) AS error_count,
  round({_RATE}, 2) AS error_pct FROM tx""",
        "error_types": f"""SELECT errors, error_count, {_SHARE.format('error_count')} AS error_share
FROM (SELECT errors, count(*) AS error_count FROM tx WHERE has_error GROUP BY errors) e""",
        "error_rate_by_card": f"SELECT card_id, {_COUNTS} FROM tx GROUP BY card_id HAVING count(*) >= 5",
        "error_rate_by_client": _CLIENT,
        "error_rate_by_category": _CATEGORY,
        "low_risk_categories": f"SELECT * FROM ({_CATEGORY}) c WHERE error_rate < 1.0",
        "low_risk_categories_fixture_policy": f"SELECT * FROM ({_CATEGORY}) c WHERE error_rate < 12.0",
        "client_context": f"SELECT c.*, credit_score FROM ({_CLIENT}) c LEFT JOIN users u ON u.id = c.client_id",
        "tx_per_card": "SELECT card_id, count(*) AS tx_count FROM tx GROUP BY card_id",
        "tx_per_client": """SELECT client_id, count(*) AS tx_count, count(DISTINCT card_id) AS card_count
FROM tx GROUP BY client_id""",
        "tx_per_merchant": """SELECT count(*) AS merchant_count, sum(n) / count(*) AS mean_tx, max(n) AS max_tx
FROM (SELECT count(*) AS n FROM tx WHERE merchant_id IS NOT NULL GROUP BY merchant_id) m""",
        "amount_bucket_shares": f"""SELECT amount_bucket, tx_count, {_SHARE.format('tx_count')} AS share_pct
FROM (SELECT {_BUCKET} AS amount_bucket, count(*) AS tx_count FROM tx
  WHERE exact_amount IS NOT NULL GROUP BY 1) b""",
        "night_activity": f"SELECT {_NIGHT} FROM tx",
        "night_activity_by_card": f"SELECT card_id, {_NIGHT} FROM tx GROUP BY card_id",
        "hour_shares": f"""SELECT tx_hour, tx_count, {_SHARE.format('tx_count')} AS share_pct,
  tx_count = max(tx_count) OVER () AS is_busiest, tx_count = min(tx_count) OVER () AS is_quietest
FROM (SELECT tx_hour, count(*) AS tx_count FROM tx GROUP BY tx_hour) h""",
        "amount_dispersion": f"""SELECT card_id, count(exact_amount) AS amount_count, {_MEAN} AS mean_amount,
  round(stddev_samp(amount_num), 6) AS stddev_amount FROM tx GROUP BY card_id""",
        "tx_per_card_hour": """SELECT card_id, tx_day, tx_hour, count(*) AS tx_count FROM tx
GROUP BY card_id, tx_day, tx_hour""",
        "card_hour_peaks": """SELECT card_id, active_hours, peak_count, peak_hour FROM (
  SELECT card_id, count(*) OVER (PARTITION BY card_id) AS active_hours, n AS peak_count, h AS peak_hour,
    row_number() OVER (PARTITION BY card_id ORDER BY n DESC, h) AS r
  FROM (SELECT card_id, CAST(date_trunc('hour', date) AS TIMESTAMP) AS h, count(*) AS n
        FROM tx GROUP BY card_id, h) g) x WHERE r = 1""",
        "impossible_travel": f"""SELECT id, card_id, previous_id, previous_city, merchant_city,
  round(km, 3) AS distance_km, hours FROM (
  SELECT *, {_DISTANCE} AS km, (epoch_us(date) - epoch_us(p_date)) / 1e6 / 3600 AS hours FROM (
    SELECT id, card_id, date, tx.merchant_city, latitude, longitude,
      lag(id) OVER w AS previous_id, lag(tx.merchant_city) OVER w AS previous_city,
      lag(date) OVER w AS p_date, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon
    FROM tx JOIN places ON tx.merchant_city = places.merchant_city
    WINDOW w AS (PARTITION BY card_id ORDER BY date, id)) s WHERE previous_id IS NOT NULL) d
WHERE km > 0 AND km > hours * 900""",
        "channel_profile": f"""SELECT use_chip, tx_count, mean_amount, error_count, error_rate,
  {_SHARE.format('tx_count')} AS share_pct FROM (SELECT use_chip, count(*) AS tx_count,
    {_MEAN} AS mean_amount, count(*) FILTER (WHERE has_error) AS error_count, {_RATE} AS error_rate
  FROM tx GROUP BY use_chip) c""",
        "velocity": """SELECT id, card_id, date,
  (epoch_us(date) - lag(epoch_us(date)) OVER (PARTITION BY card_id ORDER BY date, id)) / 1e6
    AS seconds_since_previous FROM tx""",
        "card_age": """SELECT tx.id, tx.card_id, tx_day, o.opened AS acct_open_date,
  CAST(date_sub('month', o.opened, tx_day) AS INTEGER) AS account_age_months
FROM tx LEFT JOIN (SELECT id, CAST(strptime('01/' || acct_open_date, '%d/%m/%Y') AS DATE) AS opened FROM cards) o
  ON o.id = tx.card_id""",
        "typed_cards": """SELECT id, client_id, card_number,
  last_day(CAST(strptime('01/' || expires, '%d/%m/%Y') AS DATE)) AS expires, cvv, has_chip = 'YES' AS has_chip,
  CAST(replace(credit_limit, '$', '') AS DOUBLE) AS credit_limit,
  CAST(strptime('01/' || acct_open_date, '%d/%m/%Y') AS DATE) AS acct_open_date,
  year_pin_last_changed, card_on_dark_web = 'Yes' AS card_on_dark_web FROM cards""",
        "typed_users": """SELECT id, current_age, latitude, longitude,
  CAST(replace(per_capita_income, '$', '') AS DOUBLE) AS per_capita_income,
  CAST(replace(yearly_income, '$', '') AS DOUBLE) AS yearly_income,
  CAST(replace(total_debt, '$', '') AS DOUBLE) AS total_debt, credit_score FROM users""",
        "tx_by_month": f"SELECT tx_month, count(*) AS tx_count, {_TOTAL} AS amount_total FROM tx GROUP BY 1",
        "online_geography": """SELECT coalesce(merchant_city = 'ONLINE', false)
    OR coalesce(use_chip = 'Online Transaction', false) AS is_online, count(*) AS tx_count,
  count(*) FILTER (WHERE merchant_state IS NULL) AS without_state,
  count(*) FILTER (WHERE zip IS NULL) AS without_zip FROM raw GROUP BY 1""",
        "csv_transactions_scan": f"SELECT {_RAW} FROM raw",
        "csv_cards_scan": "SELECT * FROM cards",
        "csv_users_scan": "SELECT * FROM users",
        "mcc_json_scan": "SELECT mcc, merchant_category FROM codes",
        "fraud_labels_document_scan": "SELECT transaction_id, is_fraud FROM labels",
        "fraud_labels_scan": "SELECT transaction_id, is_fraud FROM labels",
        "partitioned_write": "SELECT tx_month, count(*) AS tx_count FROM tx GROUP BY tx_month",
    }
    statements = {name: _events(select) for name, select in selects.items()}
    statements["card_daily_stats"] = _events(
        "SELECT card_id, tx_day, tx_count, city_count, day_amount FROM daily", t.DAILY
    )
    statements["card_risk_features"] = _events("SELECT * FROM card_features", t.CARD_FEATURES)
    return statements


def _export_statements(p: RiskPolicy) -> dict[str, str]:
    ctes = (t.DAILY, _flagged(p), t.CARD_FEATURES, _scores(p))
    sinks = {
        "card_risk_scores": "SELECT count(*) FROM scores",
        "suspicious_cards": "SELECT count(*) FROM flagged",
        "error_rates": "SELECT count(*) FROM (SELECT 1 FROM tx GROUP BY card_id HAVING count(*) >= 5) r",
    }
    rows = [
        f"SELECT '{form}:{name}' AS sink, ({count}) AS row_count"
        for form in ("parquet", "csv")
        for name, count in sinks.items()
    ]
    rows.append("SELECT 'parquet:enriched_transactions', count(*) FROM tx")
    rows.append(f"SELECT 'csv:enriched_sample', least(count(*), {FIXTURE_POLICY.sample_rows}) FROM tx")
    names = {"error_rates": sinks["error_rates"], "levels": "SELECT count(*) FROM scores"}
    broken = [
        f"SELECT '{form}:{name}' AS sink, {str(name == 'levels').lower()} AS failed, ({count}) AS row_count"
        for form in ("parquet", "csv")
        for name, count in names.items()
    ]
    broken.append("SELECT 'parquet:enriched_transactions', false, count(*) FROM tx")
    broken.append(f"SELECT 'csv:enriched_sample', false, least(count(*), {FIXTURE_POLICY.sample_rows}) FROM tx")
    return {
        "export_with_a_broken_sink": _events("\nUNION ALL ".join(broken), *ctes),
        "export_all": _events("\nUNION ALL ".join(rows), *ctes),
        "read_results": _events(
            """SELECT 'card_risk_scores' AS result, card_id, risk_score AS figure FROM scores
UNION ALL SELECT 'suspicious_cards', card_id, day_amount FROM flagged
UNION ALL SELECT 'error_rates', card_id, count(*) FILTER (WHERE has_error) / count(*) * 100 FROM tx
  GROUP BY card_id HAVING count(*) >= 5
UNION ALL SELECT 'enriched_transactions', card_id, amount_num FROM tc""",
            *ctes,
        ),
    }


def _lineitem_statements(p: RiskPolicy) -> dict[str, str]:
    days = (t.DAILY, _flagged(p))
    cards = (t.CARD_FEATURES, _scores(p))
    return {
        "lineitem_card_daily_stats": _lineitem(
            "SELECT card_id, tx_day, tx_count, city_count, day_amount FROM daily", t.DAILY
        ),
        "lineitem_suspicious_card_days": _lineitem(f"SELECT {_FLAGGED_COLUMNS} FROM flagged", *days),
        "lineitem_tx_by_month": _lineitem(
            f"SELECT tx_month, count(*) AS tx_count, {_TOTAL} AS amount_total FROM tx GROUP BY tx_month"
        ),
        "lineitem_one_month_again": _lineitem(
            """SELECT tx_month, count(*) AS tx_count, max(amount_num) AS amount_max FROM (
  SELECT tx_month, CASE tx_month WHEN 3 THEN 2 ELSE 1 END * amount_num AS amount_num FROM tx
  WHERE tx_month IN (2, 4) OR tx_month = 3 AND id % 2 = 0) x GROUP BY tx_month"""
        ),
        "lineitem_partitioned_write": _lineitem("SELECT tx_month, count(*) AS tx_count FROM tx GROUP BY tx_month"),
        "lineitem_card_risk_score": _lineitem("SELECT * FROM scores", *cards),
        "lineitem_segment_comparison": _lineitem(
            _SEGMENT_ROWS, *cards, _SEGMENTS.format(bound=p.high_risk_score)
        ),
    }


def all_sql() -> dict[str, str]:
    default = RiskPolicy()
    statements = {**_plain_statements(), **_rule_statements(default)}
    for name, statement in _rule_statements(FIXTURE_POLICY).items():
        statements[f"{name}_fixture_policy"] = statement
    return {**statements, **_export_statements(default), **_lineitem_statements(default)}
