"""The registered queries in plain SQL, over the same tables. Each reads whole tables."""

from __future__ import annotations

from keyrill.plans.rules import BROKER, CLUSTER, PARTITION, TOPIC

RECORDS = """
records AS (
  SELECT CAST(user_id AS VARCHAR) AS key,
         event_type || '-' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS value,
         epoch_us(ts) AS ts_us, event_id AS "offset", event_type, value AS amount
  FROM events)"""

UPSERTS = (
    RECORDS
    + """,
upserts AS (
  SELECT CASE WHEN "offset" % 50 <> 7 THEN key END AS key,
         CASE WHEN "offset" % 10 <> 3 THEN value END AS value, ts_us, "offset"
  FROM records),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts_us DESC, "offset" DESC) AS rn
    FROM upserts WHERE key IS NOT NULL)
  WHERE rn = 1 AND value IS NOT NULL)"""
)

FLAWED = (
    RECORDS
    + """,
flawed AS (
  SELECT key, ts_us, "offset",
         CASE WHEN event_type = 'error' THEN 'error-' || CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR) || '.5'
              WHEN event_type = 'view' THEN 'view- ' || CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR)
              WHEN event_type = 'signup'
                THEN 'signup-' || CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR) || '0000000000000000000'
              WHEN "offset" % 7 = 0 THEN 'click-'
              WHEN "offset" % 7 = 1 THEN NULL
              ELSE value END AS value
  FROM records),
parsed AS (
  SELECT *, CASE WHEN regexp_full_match(txt, '[+-]?[0-9]+') THEN TRY_CAST(txt AS BIGINT) END AS number
  FROM (SELECT *, substr(value, instr(value, '-') + 1) AS txt FROM flawed))"""
)

ORDERS = """
orders_in AS (
  SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS order_id,
         'item-' || json_extract_string(props, '$.k') AS appliance_id,
         CAST(value AS DECIMAL(18, 2)) AS price, epoch_us(ts) AS ts_us, event_id AS "offset", event_type
  FROM events)"""

PAIRS = (
    ORDERS
    + """,
pairs AS (
  SELECT l.key, greatest(l.ts_us, r.ts_us) AS ts_us, r.order_id AS electronic_order_id,
         l.order_id AS appliance_order_id, l.appliance_id, greatest(l.ts_us, r.ts_us) // 1000 AS time
  FROM orders_in l JOIN orders_in r
    ON l.key = r.key AND r.ts_us BETWEEN l.ts_us - 1800000000 AND l.ts_us + 1800000000
  WHERE l.event_type = 'click' AND r.event_type = 'purchase')"""
)

USERS = """,
users AS (
  SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN event_id % 10 <> 0 THEN 'user-' || event_id END AS name,
         epoch_us(ts) AS ts_us
  FROM events WHERE event_type = 'signup')"""

TICKS = """
SELECT *, (at_us + 59999999) // 60000000 * 60000000 AS first_tick,
       (at_us + 300000000 + 59999999) // 60000000 * 60000000 - 60000000 AS last_tick
FROM samples"""

SAMPLES = """
samples AS (
  SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS "user", CAST(k % 5 AS VARCHAR) AS kind,
         CASE WHEN k % 2 = 1 THEN 't' || (k % 3) ELSE '' END AS topic,
         epoch_us(ts) AS at_us, CAST(floor(value * 100) AS DOUBLE) AS value
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

INSTANTS = f"""{SAMPLES},
instants AS (
  SELECT metric, "user", kind, topic, tick_us, arg_max(value, at_us) AS value
  FROM (SELECT *, unnest(generate_series(first_tick, last_tick, 60000000)) AS tick_us FROM ({TICKS}))
  GROUP BY ALL)"""

BROKER_INSTANTS = f"""
samples AS (
  SELECT ['broker_topic_total_fetch_requests_rate_1_min', 'log_size', 'log_tier_size', 'partition_caught_up_replicas_count',
          'partition_in_sync_replicas_count', 'partition_observer_replicas_count', 'partition_replicas_count',
          'partition_under_min_isr', 'partition_under_replicated'][event_id % 9 + 1] AS metric,
         'c' || (user_id % 2) AS {CLUSTER}, 'b' || (user_id % 3) AS {BROKER},
         CASE WHEN k % 10 = 0 THEN '__cluster_metadata' ELSE event_type END AS {TOPIC},
         CAST(k % 4 AS VARCHAR) AS {PARTITION}, epoch_us(ts) AS at_us,
         CASE WHEN value < 10 THEN 0.0::DOUBLE ELSE floor(value)::DOUBLE END AS value
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
instants AS (
  SELECT metric, {CLUSTER}, {BROKER}, {TOPIC}, {PARTITION}, tick_us, arg_max(value, at_us) AS value
  FROM (SELECT *, unnest(generate_series(first_tick, last_tick, 60000000)) AS tick_us FROM ({TICKS}))
  GROUP BY ALL)"""


# The fifteen rules written out, so that they do not depend on the list under test.
RULES = """
SELECT 'code:log_size_by_broker:total' AS metric, tick_us, kafka_cluster_id, kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'log_size' AND topic <> '__cluster_metadata' GROUP BY ALL
UNION ALL
SELECT 'code:log_size_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'log_size' AND topic <> '__cluster_metadata' GROUP BY ALL
UNION ALL
SELECT 'code:partition_under_min_isr_by_broker:total' AS metric, tick_us, kafka_cluster_id, kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_under_min_isr' GROUP BY ALL
UNION ALL
SELECT 'code:log_tier_size_by_broker:total' AS metric, tick_us, kafka_cluster_id, kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'log_tier_size' AND topic <> '__cluster_metadata' GROUP BY ALL
UNION ALL
SELECT 'code:partition_replicas_count_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_replicas_count' GROUP BY ALL
UNION ALL
SELECT 'code:partition_in_sync_replicas_count_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_in_sync_replicas_count' GROUP BY ALL
UNION ALL
SELECT 'code:broker_topic_total_fetch_requests_rate_1_min_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'broker_topic_total_fetch_requests_rate_1_min' GROUP BY ALL
UNION ALL
SELECT 'code:broker_topic_total_fetch_requests_rate_1_min_by_broker:total' AS metric, tick_us, kafka_cluster_id, kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'broker_topic_total_fetch_requests_rate_1_min' GROUP BY ALL
UNION ALL
SELECT 'code:partition_under_replicated_by_broker:total' AS metric, tick_us, kafka_cluster_id, kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_under_replicated' GROUP BY ALL
UNION ALL
SELECT 'code:partition_observer_replicas_count_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_observer_replicas_count' GROUP BY ALL
UNION ALL
SELECT 'code:partition_under_replicated_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_under_replicated' GROUP BY ALL
UNION ALL
SELECT 'code:log_tier_size_by_cluster:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, '' AS topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM (SELECT tick_us, kafka_cluster_id, topic, partition, max(value) AS value FROM instants WHERE metric = 'log_tier_size' GROUP BY ALL) GROUP BY ALL
UNION ALL
SELECT 'code:partition_count_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(count(*) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_replicas_count' AND value > 0 GROUP BY ALL
UNION ALL
SELECT 'code:partition_caught_up_replicas_count_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM instants WHERE metric = 'partition_caught_up_replicas_count' GROUP BY ALL
UNION ALL
SELECT 'code:log_tier_size_by_topic:total' AS metric, tick_us, kafka_cluster_id, '' AS kafka_broker_id, topic, '' AS partition, CAST(sum(value) AS DOUBLE) AS value
FROM (SELECT tick_us, kafka_cluster_id, topic, partition, max(value) AS value FROM instants WHERE metric = 'log_tier_size' GROUP BY ALL) GROUP BY ALL"""


SESSIONS = f"""{ORDERS},
flagged AS (
  SELECT *, CASE WHEN ts_us - lag(ts_us) OVER w <= 14400000000 THEN 0 ELSE 1 END AS opens
  FROM orders_in WINDOW w AS (PARTITION BY key ORDER BY ts_us, "offset")),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY key ORDER BY ts_us, "offset" ROWS UNBOUNDED PRECEDING) AS session FROM flagged),
sessions AS (
  SELECT key, min(ts_us) AS start_us, max(ts_us) + 14400000000 AS end_us, count(*) AS records,
         CAST(sum(price) AS DOUBLE) AS total
  FROM numbered GROUP BY key, session)"""

ORACLES: dict[str, str] = {
    "order_numbers": f"""WITH {RECORDS}
SELECT key, substr(value, instr(value, '-') + 1) AS value, ts_us, "offset" FROM records
WHERE contains(value, 'purchase-') AND TRY_CAST(substr(value, instr(value, '-') + 1) AS BIGINT) > 1000""",
    "filter_contains": f"""WITH {RECORDS}
SELECT key, value, ts_us, "offset" FROM records WHERE contains(value, 'purchase-')""",
    "map_after_dash": f"""WITH {RECORDS}
SELECT key, substr(value, instr(value, '-') + 1) AS value, ts_us, "offset" FROM records""",
    "filter_number_gt": f"""WITH {FLAWED}
SELECT key, txt AS value, ts_us, "offset" FROM parsed WHERE number > 1000""",
    "scalar_suite": f"""WITH {RECORDS}, r AS (SELECT *, substr(value, instr(value, '-') + 1) AS txt FROM records)
SELECT "offset", contains(value, 'click') AS has_click, CAST(instr(value, '-') AS INTEGER) AS dash_at, txt AS number_text,
       starts_with(value, 'pu') AS starts_pu, TRY_CAST(txt AS BIGINT) AS number, TRY_CAST(txt AS DOUBLE) AS as_double,
       CAST(TRY_CAST(txt AS BIGINT) AS VARCHAR) AS number_again, TRY_CAST(txt AS BIGINT) > 1000 AS over_1000,
       amount + 0.5::DOUBLE AS plus_half, NOT regexp_full_match(value, '[+-]?[0-9]+') AS no_number,
       ts_us + 10000000 AS later_us, ts_us + 1800000000 AS half_hour_us, ts_us // 1000 AS at_ms,
       'key ' || key || ' value ' || value AS line
FROM r""",
    "tap_counts": f"""WITH {RECORDS}
SELECT 'in' AS tap, count(*) AS records, min(ts_us) AS first_us, max(ts_us) AS last_us FROM records
UNION ALL
SELECT 'out', count(*), min(ts_us), max(ts_us) FROM records
WHERE contains(value, 'purchase-') AND TRY_CAST(substr(value, instr(value, '-') + 1) AS BIGINT) > 1000""",
    "route_by_prefix": f"""WITH {RECORDS}
SELECT CASE WHEN starts_with(value, 'purchase') THEN 'orderNumberKey' WHEN starts_with(value, 'error') THEN 'bogusKey'
            ELSE 'transactionKey' END AS key, value,
       CAST(CASE WHEN starts_with(value, 'purchase') THEN 0 WHEN starts_with(value, 'error') THEN 1 ELSE 2 END AS INTEGER)
         AS "partition", "offset"
FROM records""",
    "decode_defaults": f"""WITH {ORDERS}
SELECT key, "offset", order_id, CASE WHEN price >= 10 THEN CAST(price AS DOUBLE) ELSE 0.0::DOUBLE END AS price,
       CASE WHEN "offset" % 3 = 0 THEN 'name-' || key ELSE '' END AS user_name
FROM orders_in""",
    "rekey_by_field": f"""WITH {ORDERS}
SELECT appliance_id AS key, order_id, CAST(price AS DOUBLE) AS price FROM orders_in""",
    "topic_roundtrip": f"""WITH {RECORDS}
SELECT CASE WHEN starts_with(value, 'purchase') THEN 'order' ELSE 'other' END AS key, value, ts_us,
       CAST(CASE WHEN starts_with(value, 'purchase') THEN 0 ELSE 1 END AS INTEGER) AS "partition", "offset"
FROM records""",
    "table_latest": f"""WITH {UPSERTS}
SELECT key, value, ts_us, "offset" FROM latest""",
    "table_changelog_filter": f"""WITH {UPSERTS}
SELECT key, substr(value, instr(value, '-') + 1) AS value, ts_us, "offset" FROM upserts
WHERE key IS NOT NULL AND TRY_CAST(substr(value, instr(value, '-') + 1) AS BIGINT) > 1000""",
    "table_latest_filter": f"""WITH {UPSERTS}
SELECT key, substr(value, instr(value, '-') + 1) AS value, ts_us, "offset" FROM latest
WHERE TRY_CAST(substr(value, instr(value, '-') + 1) AS BIGINT) > 1000""",
    "total_by_key": f"""WITH {ORDERS}
SELECT key, CAST(sum(price) AS DOUBLE) AS total FROM orders_in GROUP BY key""",
    "total_by_key_lineitem": """
SELECT CAST(l_partkey AS VARCHAR) AS key, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM lineitem GROUP BY ALL""",
    "running_total": f"""WITH {ORDERS}
SELECT key, "offset", CAST(price AS DOUBLE) AS price,
       CAST(sum(price) OVER (PARTITION BY key ORDER BY ts_us, "offset" ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
FROM orders_in""",
    "ordered_fold": f"""WITH {ORDERS}
SELECT key, list_reduce(list_prepend(0::BIGINT, list(CAST(price * 100 AS BIGINT) ORDER BY ts_us, "offset")),
                        lambda acc, amount: (acc * 31 + amount) % 1000003) AS fingerprint
FROM orders_in GROUP BY key""",
    "stateful_total_stream": f"""WITH {ORDERS}
SELECT key, CAST(sum(price) AS DOUBLE) AS total, count(*) AS records FROM orders_in GROUP BY key""",
    "interval_join": f"""WITH {PAIRS}
SELECT key, ts_us, electronic_order_id, appliance_order_id, appliance_id, time FROM pairs""",
    "enrich_left": f"""WITH {ORDERS}
SELECT key, "offset", coalesce(c_name, '') AS user_name
FROM orders_in LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON key = CAST(c_custkey AS VARCHAR)""",
    "enrich_asof": f"""WITH {ORDERS}{USERS}
SELECT o.key, o."offset", CAST(o.price AS DOUBLE) AS price, coalesce(u.name, '') AS name
FROM orders_in o ASOF LEFT JOIN users u ON o.key = u.key AND o.ts_us >= u.ts_us
WHERE o.event_type = 'click'""",
    "combined_orders": f"""WITH {PAIRS}{USERS}
SELECT p.key, p.ts_us, electronic_order_id, appliance_order_id, appliance_id, coalesce(u.name, '') AS user_name, time
FROM pairs p ASOF LEFT JOIN users u ON p.key = u.key AND p.ts_us >= u.ts_us""",
    "instant_values": f"""WITH {INSTANTS}
SELECT metric, tick_us, "user", kind, topic, value FROM instants""",
    "instant_sum": f"""WITH {INSTANTS}
SELECT metric, tick_us, sum(value) AS value FROM instants GROUP BY ALL""",
    "sum_by_label": f"""WITH {INSTANTS}
SELECT tick_us, kind, topic, sum(value) AS value FROM instants GROUP BY ALL""",
    "sum_by_label_neq": f"""WITH {INSTANTS}
SELECT tick_us, kind, topic, sum(value) AS value FROM instants WHERE topic <> 't1' GROUP BY ALL""",
    "sum_of_max": f"""WITH {INSTANTS}
SELECT tick_us, topic, sum(value) AS value
FROM (SELECT tick_us, kind, topic, max(value) AS value FROM instants GROUP BY ALL) GROUP BY ALL""",
    "count_positive": f"""WITH {INSTANTS}
SELECT tick_us, kind, CAST(count(*) AS DOUBLE) AS value FROM instants WHERE value > 2000 GROUP BY ALL""",
    "record_rule": f"""WITH {INSTANTS}
SELECT 'clicks_by_kind:total' AS metric, tick_us, kind, sum(value) AS value
FROM instants WHERE metric = 'click' AND topic <> 't1' GROUP BY ALL""",
    "rule_suite": f"WITH {BROKER_INSTANTS}\n{RULES}",
    "rule_suite_stream": f"""WITH {BROKER_INSTANTS}
SELECT * FROM ({RULES}) WHERE tick_us < (SELECT max(at_us) FROM samples)""",
    "promote_labels": """
SELECT event_id, 'h' || (user_id % 4) AS host_hostname, CAST(user_id % 3 AS VARCHAR) AS kafka_broker_id,
       CASE WHEN event_id % 2 = 0 THEN 'own-' || event_type ELSE event_type END AS type, '' AS process_pid,
       json_extract_string(props, '$.k') AS k, CAST(4 AS INTEGER) AS label_count
FROM events""",
    "rollup_stream": f"""WITH {SAMPLES}
SELECT at_us // 60000000 * 60000000 + 60000000 AS tick_us, kind, topic, sum(value) AS value FROM samples GROUP BY ALL""",
    "event_time": """
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
       CASE WHEN k >= 10 THEN (epoch_us(ts) // 1000 + k * 1000) * 1000 ELSE epoch_us(ts) END AS ts_us
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "tumbling_sum": f"""WITH {ORDERS}
SELECT key, ts_us // 3600000000 * 3600000000 AS start_us, ts_us // 3600000000 * 3600000000 + 3600000000 AS end_us,
       count(*) AS records, CAST(sum(price) AS DOUBLE) AS total
FROM orders_in GROUP BY ALL""",
    "hopping_sum": f"""WITH {ORDERS}, opened AS (
  SELECT *, ts_us // 900000000 * 900000000 - unnest([0, 1, 2, 3]::BIGINT[]) * 900000000 AS start_us FROM orders_in)
SELECT key, start_us, start_us + 3600000000 AS end_us, count(*) AS records, CAST(sum(price) AS DOUBLE) AS total
FROM opened GROUP BY ALL""",
    "session_sum": f"""WITH {SESSIONS}
SELECT key, start_us, end_us, records, total FROM sessions""",
    "session_sum_stream": f"""WITH {SESSIONS}
SELECT key, start_us, end_us, records, total FROM sessions
WHERE end_us <= (SELECT max(ts_us) // 1000 * 1000 - 600000000 FROM orders_in)""",
    "dead_letters": f"""WITH {FLAWED}
SELECT key, value, "offset",
       CASE WHEN value IS NULL THEN 'no value' WHEN txt = '' THEN 'empty number'
            WHEN NOT regexp_full_match(txt, '[+-]?[0-9]+') THEN 'not a whole number' ELSE 'out of range' END AS reason
FROM parsed WHERE number IS NULL""",
    "good_records": f"""WITH {FLAWED}
SELECT key, value, "offset", number FROM parsed WHERE number IS NOT NULL""",
}

ORACLES |= {
    "topic_mixed_writers": f"""WITH {RECORDS} SELECT key, value, ts_us, "offset" FROM records""",
    "running_total_double": f"""WITH {ORDERS}
SELECT key, "offset",
       CAST(sum(price * 125) OVER (PARTITION BY key ORDER BY ts_us, "offset" ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 1000 AS total
FROM orders_in WHERE key IS NOT NULL""",
    "enrich_existing_field": f"""WITH {ORDERS}
SELECT o.key, o."offset", coalesce(c.c_name, CASE WHEN o."offset" % 3 = 0 THEN 'own-' || o.order_id END, '') AS user_name
FROM orders_in o LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = o.key AND c.c_mktsegment = 'BUILDING'""",
}

DELAY_US = 3_600_000_000  # fixed value: how long the streams of several micro-batches wait for late rows


def _until(times: str, delay: int = DELAY_US) -> str:
    """The watermark at the end of a stream, in milliseconds: its newest time less the delay."""
    return f"((SELECT {times}) // 1000 - {delay // 1000})"


ORACLES |= {
    "enrich_asof_stream": f"""WITH {ORDERS}{USERS}
SELECT o.key, o."offset", CAST(o.price AS DOUBLE) AS price, coalesce(u.name, '') AS name
FROM orders_in o ASOF LEFT JOIN users u ON o.key = u.key AND o.ts_us >= u.ts_us
WHERE o.event_type = 'click' AND o.ts_us // 1000 <= {_until("least(max(ts_us) FILTER (event_type = 'click'), max(ts_us) FILTER (event_type = 'signup')) FROM orders_in")}""",
    "combined_orders_stream": f"""WITH {PAIRS}{USERS}
SELECT p.key, p.ts_us, electronic_order_id, appliance_order_id, appliance_id, coalesce(u.name, '') AS user_name, time
FROM pairs p ASOF LEFT JOIN users u ON p.key = u.key AND p.ts_us >= u.ts_us
WHERE p.ts_us // 1000 <= {_until("least((SELECT max(ts_us) FROM pairs), (SELECT max(ts_us) FROM users))", 0)}""",
    "ordered_fold_stream": f"""WITH {ORDERS}
SELECT key, list_reduce(list_prepend(0::BIGINT, list(CAST(price * 100 AS BIGINT) ORDER BY ts_us, "offset")),
                        lambda acc, amount: (acc * 31 + amount) % 1000003) AS fingerprint
FROM orders_in WHERE ts_us // 1000 <= {_until("max(ts_us) FROM orders_in")} GROUP BY key""",
    "running_total_stream": f"""WITH {ORDERS}
SELECT key, "offset", ts_us,
       CAST(sum(price) OVER (PARTITION BY key ORDER BY ts_us, "offset" ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS value
FROM orders_in WHERE ts_us // 1000 <= {_until("max(ts_us) FROM orders_in")}""",
    "silence_alarms_stream": f"""WITH {ORDERS}, gaps AS (
  SELECT *, lead(ts_us) OVER (PARTITION BY key ORDER BY ts_us, "offset") AS next_us FROM orders_in),
silent AS (SELECT * FROM gaps WHERE (next_us IS NULL OR next_us > ts_us + 86400000000) AND (ts_us + 86400000000) // 1000 <= {_until("max(ts_us) FROM orders_in")}),
before AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts_us, "offset") AS place FROM orders_in)
SELECT s.key, s.ts_us AS last_us, s.ts_us + 86400000000 AS alarm_us,
       b.place - coalesce(lag(b.place) OVER (PARTITION BY s.key ORDER BY s.ts_us), 0) AS records
FROM silent s JOIN before b USING ("offset")""",
    "table_filter_changes_stream": f"""WITH {UPSERTS}, seen AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts_us DESC, "offset" DESC) AS rn
  FROM upserts WHERE key IS NOT NULL AND ts_us // 1000 <= {_until("max(ts_us) FROM upserts WHERE key IS NOT NULL")})
SELECT key, substr(value, instr(value, '-') + 1) AS value, ts_us, "offset" FROM seen
WHERE rn = 1 AND TRY_CAST(substr(value, instr(value, '-') + 1) AS BIGINT) > 1000""",
    "store_snapshot": ORACLES["total_by_key"],
    "rule_suite_late_stream": f"""WITH {BROKER_INSTANTS}
SELECT * FROM ({RULES}) WHERE tick_us // 1000 <= {_until("max(at_us) FROM samples")}""",
    "sum_of_max_stream": f"""WITH {SAMPLES}
SELECT tick_us, topic, sum(value) AS value
FROM (SELECT at_us // 60000000 * 60000000 + 60000000 AS tick_us, kind, topic, max(value) AS value FROM samples GROUP BY ALL)
WHERE tick_us // 1000 <= {_until("max(at_us) FROM samples")} GROUP BY ALL""",
    "running_total_extremes": f"""WITH {ORDERS}, odd AS (
  SELECT *, CASE WHEN CAST(key AS BIGINT) % 4 = 0 AND "offset" % 7 = 3 THEN 'NaN'::DOUBLE
                 WHEN CAST(key AS BIGINT) % 4 = 1 AND "offset" % 7 = 3 THEN 'Infinity'::DOUBLE
                 WHEN CAST(key AS BIGINT) % 4 = 2 THEN pow(2, -60)
                 WHEN CAST(key AS BIGINT) % 4 = 3 THEN CASE WHEN "offset" % 7 = 3 THEN pow(2, 100) ELSE 0 END
                 ELSE floor(price)::DOUBLE END AS amount
  FROM orders_in),
flags AS (
  SELECT key, "offset", count(*) FILTER (isnan(amount)) OVER w AS nans, count(*) FILTER (isinf(amount)) OVER w AS infinities,
         count(*) FILTER (amount > 1e20 AND NOT isinf(amount) AND NOT isnan(amount)) OVER w AS huge
  FROM odd WINDOW w AS (PARTITION BY key ORDER BY ts_us, "offset" ROWS UNBOUNDED PRECEDING))
SELECT key, "offset", CASE WHEN nans > 0 THEN 'NaN' WHEN infinities > 0 THEN 'Infinity' ELSE '' END AS kind,
       nans > 0 OR infinities > 0 OR huge > 0 AS beyond_ones
FROM flags""",
}

# Other forms of the same query: streaming, hot keys cut, salted.
_SAME = {
    "order_numbers_stream": "order_numbers",
    "table_latest_stream": "table_latest",
    "total_by_key_stream": "total_by_key",
    "running_total_split": "running_total",
    "running_total_double_split": "running_total_double",
    "ordered_fold_split": "ordered_fold",
    "interval_join_salted": "interval_join",
    "interval_join_stream": "interval_join",
    "interval_join_salted_stream": "interval_join",
    "enrich_asof_split": "enrich_asof",
    "combined_orders_split": "combined_orders",
    "dead_letters_stream": "dead_letters",
    "tumbling_sum_stream": "tumbling_sum",
    "hopping_sum_stream": "hopping_sum",
    "session_sum_split": "session_sum",
}
ORACLES.update({name: ORACLES[same] for name, same in _SAME.items()})
