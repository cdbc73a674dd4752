"""SQL twins of the registered queries, for a check in another engine.

The common parts (catalogue, events, enrichment) are text blocks that the
queries put in front as CTEs.
"""

from __future__ import annotations

AS_OF = "2024-01-31 00:00:00"
DAY = "2024-01-30"
WEEK_START = "2024-01-24 00:00:00"
LATER = "2024-03-01 00:00:00"  # after all events
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
WAIT_SECS = 4_000
BATCH_SIZE = 500
HOT_SHARE = 0.1
LOOKUP_KEY = "eng:{c-3}:0"

_KIND = "CASE {0} % 3 WHEN 0 THEN 'podcast' WHEN 1 THEN 'newsletter' ELSE 'video' END"
_LENGTH = (
    "CAST(CASE WHEN {0} % 3 = 1 THEN NULL WHEN {0} % 50 = 0 THEN 0 "
    "ELSE 60 * {1} + {0} % 7 END AS BIGINT)"
)

CONTENT = f"""content AS (
  SELECT 'c-' || p_partkey AS id, {_KIND.format('p_partkey')} AS content_type,
         {_LENGTH.format('p_partkey', 'p_size')} AS length_seconds
  FROM part)"""

ENGAGEMENT = """engagement AS (
  SELECT event_id AS id,
         'c-' || CASE WHEN event_id % 3 = 0 THEN 3
                 ELSE user_id * 15 + (event_id % 3 - 1) * (event_id % 7) END AS content_id,
         'u-' || user_id AS user_id,
         CASE event_type WHEN 'signup' THEN 'pause' WHEN 'purchase' THEN 'finish'
              WHEN 'click' THEN 'click' ELSE 'play' END AS event_type,
         ts AS event_ts,
         CASE WHEN event_type IN ('view', 'signup', 'error')
              THEN CAST(floor(value * 1000) AS BIGINT) END AS duration_ms,
         CASE (event_id + user_id) % 6 WHEN 0 THEN 'ios' WHEN 1 THEN 'android'
              WHEN 2 THEN 'tv' WHEN 3 THEN 'tablet'
              WHEN 4 THEN 'browser' ELSE 'console' END AS device,
         props AS raw_payload
  FROM events)"""

UPDATES = f"""updates AS (
  SELECT 'c-' || p_partkey AS id, p_partkey * 4 + 1 AS seq,
         {_KIND.format('p_partkey')} AS content_type,
         {_LENGTH.format('p_partkey', 'p_size')} AS length_seconds
  FROM part
  UNION ALL
  SELECT 'c-' || k, o_orderkey * 2, {_KIND.format('k')},
         {_LENGTH.format('k', '(o_orderkey % 50 + 1)')}
  FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS k FROM orders))"""


def measures(source: str, target: str) -> str:
    """CTEs that add the measures to ``source``, which has a flag ``found``.

    The share is rounded half to even on its exact value: x * 100 is the sum of
    the product p and its error e.
    """
    k, c = "CAST(134217729 AS DOUBLE)", "CAST(100 AS DOUBLE)"
    return f"""m1 AS (
  SELECT *, CASE WHEN found AND duration_ms >= 0
                 THEN CAST(duration_ms AS DOUBLE) / CAST(1000 AS DOUBLE) END AS engagement_seconds
  FROM {source}),
m2 AS (
  SELECT *, CASE WHEN length_seconds > 0
                 THEN engagement_seconds / CAST(length_seconds AS DOUBLE) * {c} END AS x
  FROM m1),
m3 AS (SELECT *, x * {c} AS p, (x * {k} - (x * {k} - x)) AS h FROM m2),
m4 AS (SELECT *, ((h * {c} - p) + (x - h) * {c}) AS e, (p - floor(p)) - CAST(0.5 AS DOUBLE) AS r FROM m3),
{target} AS (
  SELECT * EXCLUDE (x, p, h, e, r, found),
         (floor(p) + CASE WHEN r > 0 OR (r = 0 AND (e > 0 OR (e = 0 AND CAST(floor(p) AS BIGINT) % 2 = 1)))
                          THEN 1 ELSE 0 END) / {c} AS engagement_pct,
         NOT found AS content_missing
  FROM m4)"""


ENRICHED = f"""{CONTENT},
{ENGAGEMENT},
joined AS (
  SELECT e.*, c.content_type, c.length_seconds, c.id IS NOT NULL AS found
  FROM engagement e LEFT JOIN content c ON e.content_id = c.id),
{measures('joined', 'enriched')}"""

_ASOF_JOIN = f"""{ENGAGEMENT},
{UPDATES},
arrivals AS (SELECT *, id * 3 AS seq FROM engagement),
first_seq AS (SELECT id, min(seq) AS seq FROM updates GROUP BY id),
first_version AS (SELECT u.* FROM updates u JOIN first_seq f ON u.id = f.id AND u.seq = f.seq),
back AS (
  SELECT a.*, u.id IS NOT NULL AS had, u.content_type AS b_type, u.length_seconds AS b_length
  FROM arrivals a ASOF LEFT JOIN updates u ON a.content_id = u.id AND a.seq >= u.seq)"""

_NO_BREAKS = "breaks AS (SELECT CAST(NULL AS VARCHAR) AS content_id, CAST(NULL AS BIGINT) AS last_break)"

_BREAKS = f"""timeline AS (
  SELECT content_id, seq, 2 AS kind FROM arrivals
  UNION ALL SELECT id, seq, 1 FROM updates),
gaps AS (
  SELECT t.*, f.seq AS first,
         lead(t.seq) OVER (PARTITION BY t.content_id ORDER BY t.seq, t.kind) - t.seq AS gap
  FROM timeline t JOIN first_seq f ON t.content_id = f.id),
breaks AS (
  SELECT content_id, max(seq) AS last_break FROM gaps
  WHERE seq < first AND gap > {WAIT_SECS} GROUP BY content_id)"""


def _asof(breaks: str) -> str:
    joined = """joined AS (
  SELECT b.* EXCLUDE (had, b_type, b_length, seq),
         NOT had AND f.id IS NOT NULL AND (k.last_break IS NULL OR b.seq > k.last_break) AS drained,
         CASE WHEN had THEN b_type WHEN drained THEN f.content_type END AS content_type,
         CASE WHEN had THEN b_length WHEN drained THEN f.length_seconds END AS length_seconds,
         had OR drained AS found
  FROM back b LEFT JOIN first_version f ON b.content_id = f.id
  LEFT JOIN breaks k ON b.content_id = k.content_id)"""
    return f"{_ASOF_JOIN},\n{breaks},\n{joined},\n{measures('joined', 'enriched')}"


def _asof_changes(changes: str, known: str) -> str:
    """The newest change before the event if ``known``, else the next version."""
    joined = f"""changes AS ({changes}),
back AS (
  SELECT a.*, u.id IS NOT NULL AND {known} AS had, u.content_type AS b_type, u.length_seconds AS b_length
  FROM arrivals a ASOF LEFT JOIN changes u ON a.content_id = u.id AND a.seq >= u.seq),
forth AS (
  SELECT b.*, u.id IS NOT NULL AS comes, u.content_type AS f_type, u.length_seconds AS f_length
  FROM back b ASOF LEFT JOIN updates u ON b.content_id = u.id AND b.seq <= u.seq),
joined AS (
  SELECT * EXCLUDE (had, b_type, b_length, comes, f_type, f_length, seq), NOT had AND comes AS drained,
         CASE WHEN had THEN b_type WHEN comes THEN f_type END AS content_type,
         CASE WHEN had THEN b_length WHEN comes THEN f_length END AS length_seconds, had OR comes AS found
  FROM forth)"""
    arrivals = "arrivals AS (SELECT *, id * 3 AS seq FROM engagement)"
    return f"{ENGAGEMENT},\n{UPDATES},\n{arrivals},\n{joined},\n{measures('joined', 'enriched')}"


CONTENT_TTL_SECS = 3_000
ENRICHED_ASOF_DELETES = _asof_changes("""
  SELECT *, false AS deleted FROM updates
  UNION ALL
  SELECT 'c-' || CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END, o_orderkey * 2 + 3, NULL, NULL, true
  FROM orders WHERE o_orderkey % 22 = 0""", "NOT u.deleted")
ENRICHED_ASOF_TTL = _asof_changes("SELECT * FROM updates", f"a.seq - u.seq < {CONTENT_TTL_SECS}")
ENRICHED_ASOF = _asof(_NO_BREAKS)
ENRICHED_ASOF_WAIT = _asof(_BREAKS)


def grid(value: str, digits: int = 4) -> str:
    """A double aggregate on a decimal grid, as in the queries."""
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"floor({value} * {scale} + CAST(0.50001 AS DOUBLE)) / {scale}"


_LAST = "event_ts BETWEEN TIMESTAMP '{0}' - INTERVAL {1} DAY AND TIMESTAMP '{0}'"
_MONTH = f"event_ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


def _last(days: int) -> str:
    return _LAST.format(AS_OF, days)


def _on(base: str, body: str) -> str:
    return f"WITH {base}\n{body}"


def _insights() -> dict[str, str]:
    pct, sec = "engagement_pct", "engagement_seconds"
    bodies = {
        "q_engagement_by_content_type": f"""
SELECT content_type, count(*) AS total_events, {grid(f'avg({pct})')} AS avg_engagement_pct,
       {grid(f'avg({sec})')} AS avg_engagement_seconds
FROM enriched WHERE CAST(event_ts AS DATE) = DATE '{DAY}' AND {pct} IS NOT NULL
GROUP BY content_type""",
        "q_user_patterns": f"""
SELECT user_id, count(*) AS total_events, count(DISTINCT content_id) AS unique_content,
       {grid(f'avg({pct})')} AS avg_engagement_pct
FROM enriched WHERE CAST(event_ts AS DATE) >= DATE '{AS_OF[:10]}' - INTERVAL 7 DAY AND event_type = 'play'
GROUP BY user_id HAVING count(*) >= 5
ORDER BY avg({pct}) DESC NULLS LAST, user_id LIMIT 100""",
        "q_content_performance": f"""
SELECT content_id, content_type, length_seconds, count(*) AS play_events,
       {grid(f'avg({pct})')} AS avg_completion_pct,
       count(*) FILTER ({pct} >= 90) AS high_engagement_users
FROM enriched
WHERE event_type = 'play' AND CAST(event_ts AS DATE) >= DATE '{AS_OF[:10]}' - INTERVAL 30 DAY
  AND {pct} IS NOT NULL
GROUP BY content_id, content_type, length_seconds HAVING count(*) >= 10""",
        "q_type_device_avg": f"""
SELECT content_type, device, {grid(f'avg({pct})')} AS avg_engagement_pct
FROM enriched WHERE {_last(7)} GROUP BY content_type, device""",
        "q_p90_by_type": f"""
SELECT content_type, quantile_disc({sec}, 0.9) AS percentile_90_engagement_seconds
FROM enriched WHERE {_last(30)} GROUP BY content_type""",
        "q_top_device": f"""
SELECT device, {grid(f'avg({sec})')} AS avg_engagement_seconds
FROM enriched WHERE event_type = 'play' AND {_last(30)}
GROUP BY device ORDER BY avg({sec}) DESC NULLS LAST, device LIMIT 1""",
        "q_device_stddev": f"""
SELECT device, {grid(f'stddev_samp({pct})')} AS stddev_engagement_pct
FROM enriched WHERE {sec} > 10 AND {_last(30)} GROUP BY device""",
        "q_median_high_engagement": f"""
SELECT content_type, quantile_disc({sec}, 0.5) AS median_engagement_seconds
FROM enriched WHERE {pct} > 50 AND {_last(30)} GROUP BY content_type""",
        "q_top_ios_content": f"""
SELECT content_id, {grid(f'avg({sec})')} AS avg_engagement_seconds
FROM enriched WHERE device = 'ios' AND {_last(30)}
GROUP BY content_id ORDER BY avg({sec}) DESC NULLS LAST, content_id LIMIT 3""",
        "q_long_content": f"""
SELECT content_id, {grid(f'avg({pct})')} AS avg_engagement_pct
FROM enriched WHERE length_seconds > 60 AND {_last(30)} GROUP BY content_id""",
        "q_device_stats": f"""
SELECT device, {grid(f'avg({sec})')} AS avg_engagement,
       {grid(f'stddev_samp({sec})')} AS stddev_engagement
FROM enriched WHERE {_MONTH} GROUP BY device""",
        "q_user_best_content": f"""
SELECT user_id, CASE WHEN {pct} IS NOT NULL THEN content_id END AS most_engaging_content
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                ORDER BY {pct} DESC NULLS LAST, content_id DESC) AS rn
      FROM enriched WHERE {_MONTH}) WHERE rn = 1""",
        "q_inconsistent_content": f"""
SELECT content_id, {grid(f'var_samp({pct})')} AS engagement_variance
FROM enriched WHERE {_MONTH}
GROUP BY content_id ORDER BY var_samp({pct}) DESC NULLS LAST, content_id LIMIT 10""",
        "q_length_correlation": f"""
SELECT content_type, {grid(f'corr({pct}, length_seconds)')} AS pct_length_correlation
FROM enriched WHERE {_last(7)} GROUP BY content_type""",
        "q_top5_types_per_device": f"""
SELECT device, content_type, {grid('a')} AS avg_engagement_pct, place FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY device ORDER BY a DESC NULLS LAST,
                 content_type NULLS FIRST) AS INTEGER) AS place
  FROM (SELECT device, content_type, avg({pct}) AS a FROM enriched WHERE {_last(30)}
        GROUP BY device, content_type)) WHERE place <= 5""",
        "q_total_events": "SELECT count(*) AS total_events FROM enriched WHERE NOT content_missing",
        "q_recent_events": "SELECT * EXCLUDE (content_missing) FROM enriched WHERE NOT content_missing "
                           "ORDER BY event_ts DESC, id DESC LIMIT 10",
    }
    bodies["op_quantile_array"] = "\nUNION ALL\n".join(
        f"SELECT content_type, {i} AS quantile, quantile_disc({sec}, {i / 10}) AS engagement_seconds "
        f"FROM enriched GROUP BY content_type"
        for i in range(11)
    )
    return {name: _on(ENRICHED, body) for name, body in bodies.items()}


_JSON_EVENT = """json_object('id', id, 'content_id', content_id, 'user_id', user_id,
    'event_type', event_type, 'event_ts', strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
    'duration_ms', duration_ms, 'device', device, 'raw_payload', raw_payload"""
_DOC = f"""CAST(CASE WHEN content_missing THEN {_JSON_EVENT}, '_content_missing', true)
  ELSE {_JSON_EVENT}, 'content_type', content_type, 'length_seconds', length_seconds,
    'engagement_seconds', engagement_seconds, 'engagement_pct', engagement_pct) END AS VARCHAR)"""
_PAIRS = f"""pairs AS (
  SELECT 'eng:{{' || content_id || '}}:' || id AS key, {_DOC} AS value FROM enriched)"""

_FLAWED = f"""{ENGAGEMENT},
flawed AS (
  SELECT id, CASE WHEN id % 19 <> 0 THEN content_id END AS content_id,
         CASE WHEN id % 17 <> 0 THEN user_id END AS user_id,
         CASE WHEN id % 23 = 0 THEN NULL WHEN id % 5 = 0 THEN 'x-' || event_type
              ELSE event_type END AS event_type,
         event_ts, duration_ms, CASE WHEN id % 13 <> 0 THEN device END AS device, raw_payload
  FROM engagement)"""

_EVENT_LIST = """id, content_id, user_id, event_type, epoch_us(event_ts) AS event_us, duration_ms,
  device, raw_payload"""


def oracle_sql() -> dict[str, str]:
    """SQL per query name."""
    sql = _insights()
    sql["q_source_counts"] = """
SELECT 'content' AS source_table, count(*) AS n_rows FROM part
UNION ALL SELECT 'engagement_events', count(*) FROM events"""
    sql["q_kv_lookup"] = _on(
        f"{ENRICHED},\n{_PAIRS}", f"SELECT key, value FROM pairs WHERE key = '{LOOKUP_KEY}'"
    )
    sql["q_kv_prefix_count"] = _on(
        f"{ENRICHED},\n{_PAIRS}",
        "SELECT count(*) AS n_keys FROM pairs WHERE starts_with(key, 'eng:')",
    )
    sql["op_route_changes"] = """
SELECT 'content' AS source_table, count(*) AS messages FROM part
UNION ALL SELECT 'engagement_events', count(*) FROM events"""
    sql["op_snapshot_ids"] = _on(CONTENT, "SELECT id FROM content")
    sql["op_unwrap_changes"] = _on(
        ENGAGEMENT,
        f"SELECT {_EVENT_LIST}, id * 3 AS seq, CASE WHEN id % 11 = 2 THEN '{{\"zz\":1}}' END AS extras "
        "FROM engagement WHERE id % 11 IN (0, 1, 2)",
    )
    image = f"CAST({_JSON_EVENT}) AS VARCHAR)"
    sql["op_quarantine"] = _on(ENGAGEMENT, f"""
SELECT CASE WHEN id % 11 IN (3, 4) THEN 'delete' WHEN id % 11 = 10 THEN 'invalid_json'
            ELSE 'no_after' END AS reason,
       CASE id % 11 WHEN 3 THEN '{{"before":' || {image} || ',"after":null}}'
            WHEN 4 THEN '{{"after":null,"payload":{{"after":' || {image} || '}}}}'
            WHEN 5 THEN '{{"payload":null,"n":' || id || '}}'
            WHEN 6 THEN '{{"payload":[' || id || ']}}' WHEN 7 THEN '{{"foo":' || id || '}}'
            WHEN 8 THEN 'null' WHEN 9 THEN '[' || id || ']'
            ELSE 'not json ' || id END AS value
FROM engagement WHERE id % 11 > 2""")
    sql["op_event_time"] = """
SELECT 'engagement_events' AS source_table, 'e-' || event_id AS id, epoch_us(ts) / CAST(1000000 AS DOUBLE) AS epoch
FROM events
UNION ALL
SELECT 'content', 'c-' || p_partkey,
  epoch_us(CASE WHEN p_partkey % 4 = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
       ELSE TIMESTAMP '2023-12-01 00:00:00' + to_hours(CAST(p_partkey % 600 AS INTEGER)) END)
  / CAST(1000000 AS DOUBLE)
FROM part"""
    columns = """id, content_id, user_id, event_type, event_ts, duration_ms, device, raw_payload,
  content_type, length_seconds, engagement_seconds, engagement_pct, content_missing"""
    sql["op_enrich_snapshot"] = _on(ENRICHED, f"SELECT {columns} FROM enriched")
    sql["op_enrich_beyond_broadcast"] = sql["op_enrich_snapshot"]
    sql["op_enrich_asof"] = _on(ENRICHED_ASOF, f"SELECT {columns}, drained FROM enriched")
    sql["op_enrich_asof_sliced"] = sql["op_enrich_asof"]
    sql["op_enrich_asof_wait"] = _on(ENRICHED_ASOF_WAIT, f"SELECT {columns}, drained FROM enriched")
    sql["op_enrich_asof_wait_sliced"] = sql["op_enrich_asof_wait"]
    sql["op_stream_enrich"] = _on(
        ENRICHED,
        f"SELECT {_EVENT_LIST}, content_type, length_seconds, engagement_seconds, engagement_pct, "
        "content_missing FROM enriched",
    )
    sql["op_stream_enrich_sliced"] = sql["op_stream_enrich"]
    sql["op_stream_enrich_buckets"] = sql["op_stream_initial_state"] = sql["op_stream_enrich"]
    sql["op_enrich_asof_deletes"] = _on(ENRICHED_ASOF_DELETES, f"SELECT {columns}, drained FROM enriched")
    sql["op_enrich_asof_deletes_sliced"] = sql["op_enrich_asof_deletes"]
    sql["op_enrich_asof_ttl"] = _on(ENRICHED_ASOF_TTL, f"SELECT {columns}, drained FROM enriched")
    sql["op_enrich_asof_ttl_sliced"] = sql["op_enrich_asof_ttl"]
    sql["op_stream_enrich_deletes"] = _on(
        ENRICHED_ASOF_DELETES,
        f"SELECT {_EVENT_LIST}, content_type, length_seconds, engagement_seconds, engagement_pct, "
        "content_missing, drained FROM enriched")
    sql["op_stream_hot_ids"] = _on(ENGAGEMENT, f"""
SELECT content_id FROM engagement GROUP BY content_id
HAVING count(*) >= {HOT_SHARE} * (SELECT count(*) FROM engagement)""")
    sql["op_state_known_content"] = _on(CONTENT, "SELECT id, content_type, length_seconds FROM content")
    sql["op_latest_content"] = _on(UPDATES, """
SELECT id, seq, content_type, length_seconds FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM updates) WHERE rn = 1""")
    sql["op_union_tagged"] = _on(f"{CONTENT},\n{ENGAGEMENT}", """
SELECT content_id, 'main' AS tag, id AS event_id, CAST(NULL AS VARCHAR) AS content_type,
       CAST(NULL AS BIGINT) AS length_seconds FROM engagement
UNION ALL SELECT id, 'content', NULL, content_type, length_seconds FROM content""")
    sql["op_content_cache_size"] = _on(UPDATES, "SELECT count(DISTINCT id) AS cached_items FROM updates")
    sql["op_stream_cache_size"] = "SELECT count(DISTINCT p_partkey) AS cached_items FROM part"
    sql["op_counters"] = _on(ENRICHED_ASOF_WAIT, """
SELECT CAST(sum(CASE WHEN content_missing THEN 0 ELSE 1 END) AS BIGINT) AS enriched,
       CAST(sum(CASE WHEN content_missing THEN 1 ELSE 0 END) AS BIGINT) AS missing_content,
       count(DISTINCT CASE WHEN drained THEN content_id END) AS flushed_pending
FROM enriched""")
    missing = "concat_ws(',', " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '{c}' END"
        for c in ("content_id", "user_id", "event_type", "device")
    ) + ")"
    sql["op_required_rejects"] = _on(_FLAWED, f"""
SELECT id, {missing} AS missing FROM flawed
WHERE content_id IS NULL OR user_id IS NULL OR event_type IS NULL OR device IS NULL""")
    sql["op_domain_rejects"] = _on(_FLAWED, """
SELECT id, event_type FROM flawed WHERE event_type NOT IN ('play', 'pause', 'finish', 'click')""")
    sql["op_fk_rejects"] = _on(f"{CONTENT},\n{_FLAWED}", """
SELECT f.id, f.content_id FROM flawed f
WHERE f.content_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM content c WHERE c.id = f.content_id)""")
    sql["op_key_duplicates"] = _on(UPDATES, """
SELECT id, count(*) AS copies FROM updates GROUP BY id HAVING count(*) > 1""")
    sql["op_kv_projection"] = _on(f"{ENRICHED},\n{_PAIRS}", "SELECT key, value FROM pairs")
    sql["op_delivery_batches"] = _on(ENRICHED, f"""
SELECT CAST(id // {BATCH_SIZE} AS BIGINT) AS batch_no, count(*) AS n_events,
       '{{"events":[' || string_agg({_DOC}, ',' ORDER BY id) || ']}}' AS body
FROM enriched GROUP BY 1""")
    sql["op_delivery_receipts"] = _on(ENRICHED, f"""
SELECT 'http' AS sink, 'ok' AS status, CAST(sum(n) AS BIGINT) AS events, count(*) AS requests
FROM (SELECT id // {BATCH_SIZE}, count(*) AS n FROM enriched GROUP BY 1)""")
    sql["op_delivery_stream"] = _on(ENRICHED, "SELECT 'ok' AS status, CAST(count(*) AS BIGINT) AS events FROM enriched")
    # a column per unknown field: when an event has it, when it is null, its type over all events
    drifted = [
        ("app_version", "id % 4 = 0", "false", "STRING"), ("volume", "id % 3 = 0", "false", "DECIMAL(21,1)"),
        ("ref", "id % 7 < 3", "false", "VARIANT"), ("geo", "id % 10 = 0", "false", "OBJECT<zone: BIGINT>"),
        ("muted", "id % 2 = 0", "id % 12 = 0", "BOOLEAN"), ("gone", "id % 6 = 5", "true", "VOID"),
        ("Device", "id % 13 = 0", "false", "STRING")]
    sql["op_drift_fields"] = _on(ENGAGEMENT, " UNION ALL ".join(
        f"SELECT '{name}' AS field, '{kind}' AS type, count(*) AS n_rows, count_if({null}) AS n_null "
        f"FROM engagement WHERE {there}" for name, there, null, kind in drifted))
    sql["op_drift_promoted"] = _on(ENGAGEMENT, """
SELECT id, content_id, CASE WHEN id % 4 = 0 THEN 'v' || id % 9 END AS app_version,
       CASE WHEN id % 2 = 0 AND id % 12 <> 0 THEN id % 4 = 2 END AS muted,
       CASE WHEN id % 6 = 0 THEN CAST(id AS DOUBLE) END AS volume
FROM engagement""")
    sql["op_warehouse_layout"] = _on(ENRICHED, """
SELECT strftime(event_ts, '%Y-%m-%d') AS event_date, content_type, event_type, count(*) AS n_rows
FROM enriched WHERE NOT content_missing GROUP BY 1, 2, 3""")
    sql["op_warehouse_two_runs"] = _on(ENRICHED, """
SELECT id, content_id, event_type, epoch_us(event_ts) AS event_us FROM enriched WHERE NOT content_missing""")
    for name in ("engagement_by_content_type", "content_performance", "type_device_avg", "device_stats"):
        sql[f"q_{name}_warehouse"] = sql[f"q_{name}"].replace(
            "FROM enriched", "FROM (SELECT * FROM enriched WHERE NOT content_missing)")
    for name in ("type_device_avg", "device_stddev", "device_stats", "length_correlation", "inconsistent_content",
                 "user_patterns"):
        sql[f"q_{name}_rollup"] = sql[f"q_{name}"]
    sql["q_kv_expired"] = _on(f"{ENRICHED},\n{_PAIRS}", """
SELECT key FROM pairs WHERE CAST(split_part(key, ':', 3) AS BIGINT) % 3 <> 0""")
    sql["op_quality_report"] = _on(f"{CONTENT},\n{_FLAWED}", """
SELECT 'required' AS rule, c AS subject, count(*) FILTER (WHERE CASE c
  WHEN 'id' THEN id IS NULL WHEN 'content_id' THEN content_id IS NULL WHEN 'user_id' THEN user_id IS NULL WHEN 'event_type' THEN event_type IS NULL WHEN 'event_ts' THEN event_ts IS NULL WHEN 'device' THEN device IS NULL WHEN 'raw_payload' THEN raw_payload IS NULL END) AS n_rows
FROM flawed, (SELECT unnest(['id', 'content_id', 'user_id', 'event_type', 'event_ts', 'device', 'raw_payload']) AS c) GROUP BY c
UNION ALL SELECT 'domain', 'event_type', count(*) FROM flawed
WHERE event_type NOT IN ('play', 'pause', 'finish', 'click')
UNION ALL SELECT 'reference', 'content_id', count(*) FROM flawed f
WHERE f.content_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM content c WHERE c.id = f.content_id)
UNION ALL SELECT 'unique', 'id', CAST(coalesce(sum(n), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM flawed GROUP BY id HAVING count(*) > 1)""")
    sql["op_stream_quarantine"] = sql["op_quarantine"]
    sql["op_tumbling_counts"] = _on(ENGAGEMENT, """
SELECT CAST(epoch_us(event_ts) // 21600000000 * 21600 AS DOUBLE) AS window_epoch, event_type, count(*) AS n_events
FROM engagement GROUP BY 1, 2""")
    sql["op_dedup_events"] = _on(ENGAGEMENT, "SELECT id, device, id * 3 AS seq FROM engagement")
    return sql
