"""Common table expressions that rebuild the inputs of the queries in SQL."""

# Transactions of mapping A with number, calendar and error columns.
EVENTS = """
raw AS (
  SELECT event_id AS id, ts AS date, user_id % 40 AS client_id, user_id AS card_id,
    '$' || CAST(CAST(CASE WHEN event_type = 'signup' AND k < 25 THEN -value ELSE value END
                     AS DECIMAL(12,2)) AS VARCHAR) AS amount,
    CASE event_type WHEN 'purchase' THEN 'Chip Transaction'
      WHEN 'click' THEN 'Online Transaction' ELSE 'Swipe Transaction' END AS use_chip,
    event_id % 97 AS merchant_id,
    CASE WHEN k < 90 THEN n_name END AS merchant_city,
    CASE WHEN event_type <> 'click' AND k < 85 THEN 'S' || (k % 25) END AS merchant_state,
    CASE WHEN event_type <> 'click' AND k < 80
      THEN lpad(CAST(k * 37 AS VARCHAR), 5, '0') END AS zip,
    k AS mcc,
    CASE WHEN event_type = 'error' AND k < 60 THEN
      CASE event_id % 4 WHEN 0 THEN 'Bad PIN' WHEN 1 THEN 'Technical Glitch'
        ELSE 'Insufficient Balance' END END AS errors
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN nation ON n_nationkey = k % 25
),
cards AS (
  SELECT CASE WHEN c_custkey % 50 = 49 THEN -c_custkey ELSE c_custkey END AS id,
    CAST(c_nationkey AS BIGINT) AS client_id, c_name AS card_number,
    lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '/' || (c_custkey % 10 + 2020) AS expires,
    lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS cvv,
    CASE WHEN c_custkey % 10 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
    '$' || CAST(floor(abs(c_acctbal)) AS BIGINT) AS credit_limit,
    lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '/' || (c_custkey % 25 + 1995)
      AS acct_open_date,
    CAST(c_custkey % 10 + 2010 AS INTEGER) AS year_pin_last_changed,
    CASE WHEN c_custkey % 40 = 7 THEN 'Yes' ELSE 'No' END AS card_on_dark_web
  FROM customer
),
users AS (
  SELECT s_suppkey AS id, CAST(s_suppkey % 60 + 18 AS INTEGER) AS current_age,
    CAST(s_suppkey % 90 AS DOUBLE) AS latitude, CAST(s_suppkey % 180 AS DOUBLE) AS longitude,
    '$' || CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS per_capita_income,
    '$' || CAST(CAST(s_acctbal * 2 AS DECIMAL(12,2)) AS VARCHAR) AS yearly_income,
    '$' || CAST(CAST(s_acctbal * 3 AS DECIMAL(12,2)) AS VARCHAR) AS total_debt,
    CAST(s_suppkey % 551 + 300 AS INTEGER) AS credit_score
  FROM supplier
),
codes AS (
  SELECT CASE WHEN p_partkey < 80 THEN '' ELSE 'x' END || p_partkey AS mcc,
    p_brand AS merchant_category
  FROM part
),
labels AS (
  SELECT event_id AS transaction_id,
    (event_type = 'error' AND event_id % 10 < 3) OR event_id % 50 = 0 AS is_fraud
  FROM events
),
places AS (
  SELECT n_name AS merchant_city, CAST((n_nationkey * 37) % 120 - 60 AS DOUBLE) AS latitude,
    CAST((n_nationkey * 83) % 360 - 180 AS DOUBLE) AS longitude
  FROM nation
)"""

# Line items as transactions.
LINEITEM = """
raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS date, o_custkey AS card_id,
    '$' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS amount,
    n_name AS merchant_city, CAST(l_partkey % 100 AS INTEGER) AS mcc,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'Bad PIN' END AS errors
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

# Features on top of either raw table.
FEATURES = """
tx AS (
  SELECT *,
    CAST(exact_amount AS DOUBLE) AS amount_num,
    CAST(hour(date) AS INTEGER) AS tx_hour,
    CAST(dayofweek(date) + 1 AS INTEGER) AS tx_weekday,
    CAST(month(date) AS INTEGER) AS tx_month,
    CAST(date AS DATE) AS tx_day,
    errors IS NOT NULL AND errors <> '' AS has_error
  FROM (SELECT *, TRY_CAST(replace(replace(amount, '$', ''), ',', '') AS DECIMAL(38,6))
          AS exact_amount FROM raw) r
)"""

CATEGORIES = """
tc AS (
  SELECT tx.*, merchant_category
  FROM tx LEFT JOIN codes ON tx.mcc = TRY_CAST(codes.mcc AS BIGINT)
)"""

DAILY = """
daily AS (
  SELECT card_id, tx_day, count(*) AS tx_count, count(DISTINCT merchant_city) AS city_count,
    CAST(sum(exact_amount) AS DOUBLE) AS day_amount, sum(exact_amount) AS day_exact
  FROM tx GROUP BY card_id, tx_day
)"""

CARD_FEATURES = """
card_features AS (
  SELECT card_id, count(*) AS total_transactions,
    count(DISTINCT merchant_city) AS city_count,
    CAST(sum(exact_amount) AS DOUBLE) AS amount_total,
    CAST(sum(exact_amount) AS DOUBLE) / count(exact_amount) AS amount_mean,
    CAST(max(exact_amount) AS DOUBLE) AS amount_max,
    count(*) FILTER (WHERE has_error) AS error_count,
    count(*) FILTER (WHERE has_error) / count(*) * 100 AS error_rate,
    count(DISTINCT tx_day) AS active_days,
    count(*) / nullif(count(DISTINCT tx_day), 0) AS tx_per_active_day,
    count(DISTINCT mcc) AS mcc_count
  FROM tx GROUP BY card_id
)"""
