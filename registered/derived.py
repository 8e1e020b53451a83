"""SQL definitions of the derived tables, matching ``cohorta.plans.views``."""

SCORED = """
scored AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, y AS returned,
         pts / 1000::DOUBLE AS predicted_probability,
         CASE WHEN pts >= 500 THEN 1 ELSE 0 END AS predicted_class,
         (1 + l_linenumber % 2)::INTEGER AS model_version,
         l_shipdate AS reference_date,
         l_quantity AS quantity, l_discount AS discount,
         l_extendedprice AS extended_price, l_linestatus AS line_status
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
               (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 700
               + 300 * CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS pts
        FROM lineitem)
)"""

COHORTS = (
    SCORED
    + """,
cohorts AS (
  SELECT 'batch' AS source,
         CASE WHEN reference_date < TIMESTAMP '1999-01-01' THEN 'reference' ELSE 'analysis' END AS period,
         model_version, CAST(date_trunc('month', reference_date) AS TIMESTAMP) AS reference_date,
         predicted_probability, predicted_class,
         CASE WHEN reference_date < TIMESTAMP '1999-01-01' OR line_status <> 'O' THEN returned END AS returned,
         quantity, discount, extended_price, line_status
  FROM scored
)"""
)

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customerid, 18 + c_custkey % 98 AS age, c_custkey % 60 AS tenure,
         coalesce(n, 0) AS usage_frequency, c_custkey % 11 AS support_calls,
         c_custkey % 31 AS payment_delay, c_custkey % 30 AS last_interaction,
         round(coalesce(spent, 0.0::DOUBLE), 2) AS total_spend,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CASE c_custkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Standard' ELSE 'Premium' END AS subscription_type,
         CASE c_custkey % 4 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Quarterly' WHEN 2 THEN 'Annual' ELSE 'Weekly' END AS contract_length,
         CASE WHEN ((c_custkey % 11 >= 6 OR c_custkey % 31 > 20) <> (c_custkey % 17 = 0)) THEN 1 ELSE 0 END::BIGINT AS churn,
         CAST(date_trunc('month', last_order) AS TIMESTAMP) AS reference_date
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spent, max(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
),
valid_customers AS (
  SELECT * FROM customers WHERE contract_length <> 'Weekly' AND reference_date IS NOT NULL
)"""

API = """
api_events AS (
  SELECT CASE WHEN event_type = 'error' THEN 'prediction_error' ELSE 'prediction' END AS event,
         event_id, event_id::VARCHAR AS request_id, ts AS reference_date, value AS latency_ms,
         (1 + user_id % 2)::INTEGER AS model_version,
         pts / 1000::DOUBLE AS predicted_probability,
         CASE WHEN pts >= 500 THEN 1 ELSE 0 END AS predicted_class,
         value AS amount, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         (user_id % 4)::VARCHAR AS channel,
         CASE WHEN pts + event_id % 500 >= 700 THEN 1 ELSE 0 END AS converted
  FROM (SELECT *, (event_id * 7919 + user_id * 31) % 1000 AS pts FROM events)
),
api_days AS (
  SELECT CASE WHEN reference_date < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'analysis' END AS period,
         CAST(date_trunc('day', reference_date) AS TIMESTAMP) AS reference_date,
         * EXCLUDE (reference_date)
  FROM api_events
)"""


def with_views(*views: str, query: str) -> str:
    return f"WITH {','.join(views)}\n{query}"
