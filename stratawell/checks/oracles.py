"""The SQL twin of each query, over the given tables only."""

from __future__ import annotations

_DIRTY_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_id % 89 = 0 THEN ''
                WHEN event_id % 83 = 0 THEN CAST(ts + INTERVAL 5 HOUR AS VARCHAR) || '+05:00'
                ELSE CAST(ts AS VARCHAR) END AS ts,
           CAST(user_id AS VARCHAR) AS user_id,
           CASE WHEN event_id % 5 = 0 THEN '  ' || upper(event_type) || ' '
                ELSE event_type END AS event_type,
           CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
           props,
           CASE event_id % 3 WHEN 0 THEN '007' WHEN 1 THEN '' ELSE '12' END AS code,
           CAST(event_id % 2 AS INTEGER) AS load_no
    FROM events WHERE event_id % 2 = 1 OR event_id % 3 = 0
"""

_REVISED = """
    SELECT event_id, ts + INTERVAL 5 MINUTE AS ts, user_id, event_type, value + 1 AS value, props
    FROM events WHERE event_id % 10 = 0
"""

_UPSERT = f"""
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS r FROM (
            SELECT * FROM events
            UNION ALL {_REVISED}
            UNION ALL SELECT event_id + 1000000, ts, user_id, event_type, value, props
                      FROM events WHERE event_id % 50 = 0
        )
    ) WHERE r = 1
"""

# Every fourth key is there twice; those of changed keys are one row in the end.
_UPSERT_REPEATED = f"""
    {_UPSERT}
    UNION ALL SELECT * FROM events WHERE event_id % 4 = 0 AND event_id % 10 <> 0
"""

_SIDES = """
    SELECT 'accepted' AS outcome, event_id, {ts} AS ts, user_id, event_type, {value} AS value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           NULL AS reason, NULL AS raw_value, NULL AS raw_id
    FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
    UNION ALL
    SELECT 'quarantined', event_id, CASE WHEN event_id % 89 <> 0 THEN ts END, user_id, event_type,
           CASE WHEN event_id % 97 <> 0 THEN value END,
           CAST(json_extract_string(props, '$.k') AS INTEGER),
           concat_ws(',', CASE WHEN event_id % 97 = 0 THEN 'unfit:value' END,
                          CASE WHEN event_id % 89 = 0 THEN 'ts' END,
                          CASE WHEN event_id % 97 = 0 THEN 'value' END),
           CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END,
           CAST(event_id AS VARCHAR)
    FROM ({both}) WHERE event_id % 97 = 0 OR event_id % 89 = 0
"""

_MONEY = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"

_HISTORY = """
    SELECT user_id, ts, event_id, event_type, value, gone,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
    FROM (
        SELECT event_id % 50 AS user_id, ts, event_id, event_type, value, event_id % 7 = 3 AS gone
        FROM (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM events)
        QUALIFY row_number() OVER (PARTITION BY event_id % 50, ts ORDER BY event_id DESC) = 1
    )
"""

_SNAPSHOT = """
    SELECT * REPLACE (CASE WHEN o_orderkey % 500 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
    FROM orders WHERE o_orderkey % 400 <> 9
    UNION ALL
    SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 300 = 11
    UNION ALL SELECT * FROM orders WHERE o_orderkey % 1000 = 50
"""

ORACLES: dict[str, str] = {
    "csv_source": "SELECT * FROM orders",
    "file_stream_source": "SELECT * FROM events",
    "incremental_ingest": """
        WITH c AS (
            SELECT count(*) FILTER (WHERE event_id % 4 < 2) AS a,
                   count(*) FILTER (WHERE event_id % 4 >= 2) AS b
            FROM events
        )
        SELECT CAST(1 AS INTEGER) AS run_no, a AS rows_added, a AS rows_total FROM c
        UNION ALL SELECT CAST(2 AS INTEGER), b, a + b FROM c
        UNION ALL SELECT CAST(3 AS INTEGER), CAST(0 AS BIGINT), a + b FROM c
    """,
    "event_source": """
        SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition_id, count(*) AS n,
               min(event_id) AS first_offset, max(event_id) AS last_offset
        FROM events GROUP BY 2
    """,
    "bronze_append": _DIRTY_EVENTS,
    "silver_build": _SIDES.format(
        ts="ts",
        value="value",
        both="SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0",
    ),
    "silver_update": _SIDES.format(
        ts="CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 5 MINUTE ELSE ts END",
        value="CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END",
        both=f"SELECT * FROM events UNION ALL {_REVISED}",
    ),
    "create_layers": """
        SELECT 'bronze' AS layer, count(*) AS n FROM events
        UNION ALL
        SELECT 'silver', count(*) FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
        UNION ALL
        SELECT 'quarantined', count(*) FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
    """,
    "dashboard_dataset": f"""
        SELECT 'by_status' AS panel, o_orderstatus, o_orderpriority, CAST(NULL AS DATE) AS month,
               CAST(NULL AS BIGINT) AS o_custkey, count(*) AS n,
               {_MONEY.format('o_totalprice')} AS revenue
        FROM orders GROUP BY 2, 3
        UNION ALL
        SELECT 'by_month', o_orderstatus, NULL, CAST(date_trunc('month', o_orderdate) AS DATE), NULL,
               count(*), {_MONEY.format('o_totalprice')}
        FROM orders GROUP BY o_orderstatus, date_trunc('month', o_orderdate)
        UNION ALL
        SELECT 'totals', NULL, NULL, NULL, NULL, count(*), {_MONEY.format('o_totalprice')} FROM orders
        UNION ALL
        SELECT 'largest', NULL, NULL, NULL, o_custkey, n, revenue FROM (
            SELECT o_custkey, count(*) AS n, {_MONEY.format('o_totalprice')} AS revenue
            FROM orders GROUP BY 1 ORDER BY revenue DESC, o_custkey LIMIT 10
        )
    """,
    "stream_sink": """
        SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS distinct_ids
        FROM events GROUP BY 1
    """,
    "payload_decode": """
        SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition_id,
               event_id AS event_offset,
               CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN ts END AS ts,
               CASE WHEN good THEN user_id END AS user_id,
               CASE WHEN good THEN event_type END AS event_type,
               CASE WHEN good THEN value END AS value, CASE WHEN good THEN props END AS props,
               NOT good AND event_id % 107 <> 0 AS corrupt, event_id % 107 <> 0 AS has_payload
        FROM (
            SELECT *, event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0
                      AND event_id % 109 <> 0 AND event_id % 127 <> 0 AND event_id % 131 <> 0 AS good
            FROM events
        )
    """,
    "layer_read": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45",
    "conform": """
        SELECT event_id, CASE WHEN event_id % 89 <> 0 THEN ts END AS ts, user_id, event_type,
               CASE WHEN event_id % 97 <> 0 THEN value END AS value, props
        FROM events
    """,
    "validity_split": """
        SELECT CASE WHEN reason = '' THEN 'accepted' ELSE 'quarantined' END AS outcome,
               reason, count(*) AS n
        FROM (
            SELECT concat_ws(',', CASE WHEN event_id % 89 = 0 THEN 'ts' END,
                                  CASE WHEN event_id % 97 = 0 THEN 'value' END) AS reason
            FROM events
        ) GROUP BY 1, 2
    """,
    "key_history": f"""
        WITH h AS ({_HISTORY})
        SELECT 'all' AS reading, user_id, ts, valid_to, event_id, event_type, value FROM h WHERE NOT gone
        UNION ALL
        SELECT 'as_of', user_id, ts, valid_to, event_id, event_type, value FROM h
        WHERE NOT gone AND ts <= TIMESTAMP '2024-01-15 00:00:00'
              AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15 00:00:00')
    """,
    "snapshot_changes": f"""
        WITH n AS ({_SNAPSHOT}),
        came AS (SELECT * FROM n EXCEPT ALL SELECT * FROM orders),
        went AS (SELECT * FROM orders EXCEPT ALL SELECT * FROM n)
        SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM went) THEN 'update_to' ELSE 'insert' END
               AS change, * FROM came
        UNION ALL
        SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM came) THEN 'update_from' ELSE 'delete' END,
               * FROM went
    """,
    "snapshot_read": _SNAPSHOT,
    "dashboard_updates": f"""
        SELECT 'by_status' AS panel, o_orderstatus, o_orderpriority, CAST(NULL AS DATE) AS month,
               CAST(NULL AS BIGINT) AS o_custkey, count(*) AS n,
               {_MONEY.format('o_totalprice')} AS revenue, max(o_totalprice) AS most,
               CAST(NULL AS BOOLEAN) AS close
        FROM orders GROUP BY 2, 3
        UNION ALL
        SELECT 'by_month', o_orderstatus, NULL, CAST(date_trunc('month', o_orderdate) AS DATE), NULL,
               count(*), {_MONEY.format('o_totalprice')}, max(o_totalprice), NULL
        FROM orders GROUP BY o_orderstatus, date_trunc('month', o_orderdate)
        UNION ALL
        SELECT 'totals', NULL, NULL, NULL, NULL, count(*), {_MONEY.format('o_totalprice')},
               max(o_totalprice), true FROM orders
        UNION ALL
        SELECT 'largest', NULL, NULL, NULL, o_custkey, n, revenue, most, NULL FROM (
            SELECT o_custkey, count(*) AS n, {_MONEY.format('o_totalprice')} AS revenue,
                   max(o_totalprice) AS most
            FROM orders GROUP BY 1 ORDER BY revenue DESC, o_custkey LIMIT 10
        )
    """,
    "rest_of_fields": """
        SELECT event_id, value, CAST(event_id % 3 AS VARCHAR) AS wave,
               CASE event_id % 3 WHEN 1 THEN CAST(event_id AS VARCHAR)
                                 WHEN 2 THEN CASE WHEN event_id % 5 <> 0 THEN 'z' || event_id END END AS zz,
               CASE WHEN event_id % 3 = 2 THEN event_id END AS p
        FROM events
    """,
    "field_drift": """
        SELECT '1' AS wave, 'zz' AS field, 'BIGINT' AS type, count(*) AS n FROM events WHERE event_id % 3 = 1
        UNION ALL
        SELECT '2', 'zz', 'STRING', count(*) FROM events WHERE event_id % 3 = 2 AND event_id % 5 <> 0
        UNION ALL
        SELECT '2', 'more', 'OBJECT<p: BIGINT, q: ARRAY<BIGINT>>', count(*) FROM events WHERE event_id % 3 = 2
        UNION ALL SELECT 'all', 'zz', 'variant', CAST(0 AS BIGINT)
        UNION ALL SELECT 'all', 'more', 'struct<p:bigint,q:array<bigint>>', CAST(0 AS BIGINT)
    """,
    "offset_continuity": """
        WITH s AS (SELECT (max(event_id) + 1) // 10 AS n, max(event_id) AS top FROM events),
        e AS (SELECT event_id, CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o, n, top FROM events, s),
        r AS (
            SELECT 1 AS run, p, o FROM e WHERE event_id < 4 * n
            UNION ALL SELECT 2, p, o FROM e WHERE event_id >= 3 * n AND event_id < 6 * n
            UNION ALL SELECT 3, p, o FROM e WHERE event_id >= 7 * n
        )
        SELECT 1 AS run, p AS partition_id, min(o) AS first, max(o) AS last, 'new' AS kind FROM r WHERE run = 1 GROUP BY p
        UNION ALL
        SELECT 2, p, min(o), max(o), 'replay' FROM r
        WHERE run = 2 AND (p, o) IN (SELECT (p, o) FROM r WHERE run = 1) GROUP BY p
        UNION ALL
        SELECT 2, p, min(o), max(o), 'new' FROM r
        WHERE run = 2 AND (p, o) NOT IN (SELECT (p, o) FROM r WHERE run = 1) GROUP BY p
        UNION ALL
        SELECT 3, p, min(o), max(o), 'new' FROM r WHERE run = 3 GROUP BY p
        UNION ALL
        SELECT 3, p, max(o) FILTER (WHERE run = 2) + 1, min(o) FILTER (WHERE run = 3) - 1, 'gap' FROM r GROUP BY p
        UNION ALL
        SELECT 0, p, CAST(count(DISTINCT o) AS BIGINT), CAST(count(DISTINCT o) AS BIGINT), 'events' FROM r GROUP BY p
    """,
    "filled_series": """
        WITH o AS (SELECT * FROM orders WHERE o_custkey % 10 = 3),
        b AS (SELECT date_trunc('month', min(o_orderdate)) AS first, date_trunc('month', max(o_orderdate)) AS last FROM o),
        m AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
        s AS (SELECT DISTINCT o_orderstatus FROM o),
        f AS (
            SELECT m.month, s.o_orderstatus, count(o.o_orderkey) AS n,
                   sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS revenue
            FROM m CROSS JOIN s LEFT JOIN o
              ON date_trunc('month', o.o_orderdate) = m.month AND o.o_orderstatus = s.o_orderstatus
            GROUP BY 1, 2
        )
        SELECT row_number() OVER w - 1 AS nr, month, o_orderstatus, n,
               CAST(revenue AS DOUBLE) AS revenue,
               CAST(sum(n) OVER w AS BIGINT) AS n_so_far, CAST(sum(revenue) OVER w AS DOUBLE) AS revenue_so_far,
               CAST(sum(n) OVER (PARTITION BY o_orderstatus ORDER BY month ROWS 2 PRECEDING) AS BIGINT) AS n_quarter,
               CAST(max(revenue) OVER (PARTITION BY o_orderstatus ORDER BY month ROWS 2 PRECEDING) AS DOUBLE) AS best
        FROM f WINDOW w AS (PARTITION BY o_orderstatus ORDER BY month)
    """,
    "append_new": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN 'L2'
                               WHEN o_orderkey % 3 = 0 THEN 'L3' ELSE o_orderstatus END AS o_orderstatus)
        FROM orders
    """,
    "row_rules": """
        WITH d AS (
            SELECT event_id, user_id, value FROM events
            UNION ALL SELECT event_id + 1000000, user_id, value FROM events WHERE event_id % 50 = 0
            UNION ALL SELECT 3000000 + event_id, user_id, 1e9 FROM events WHERE event_id % 500 = 1
        ),
        f AS (SELECT user_id, value, min(event_id) AS first FROM d GROUP BY 1, 2)
        SELECT event_id,
               concat_ws(',', CASE WHEN first <> event_id THEN 'twice:' || first END,
                              CASE WHEN user_id % 9 = 4 THEN 'user:' || user_id END,
                              CASE WHEN value = 1e9 THEN 'odd' END) AS reasons
        FROM d JOIN f USING (user_id, value)
    """,
    "clustered_read": """
        SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
        WHERE l_partkey BETWEEN 50 AND 90 AND l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-03-31'
    """,
    "late_rows": """
        SELECT 'passed' AS outcome, event_id, event_type FROM events
        UNION ALL SELECT 'late', event_id + 10000000, event_type FROM events
                  WHERE event_id % 10 = 3 AND event_id < (SELECT max(event_id) // 4 FROM events)
        UNION ALL SELECT 'untimed', event_id + 20000000, event_type FROM events WHERE event_id % 50 = 7
    """,
    "upsert_deletes": f"""
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS r FROM (
                SELECT *, false AS gone FROM events
                UNION ALL SELECT *, event_id % 20 = 0 FROM ({_REVISED})
            )
        ) WHERE r = 1 AND NOT gone
    """,
    "dedup_batch": f"""
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS r FROM (
                SELECT * FROM events UNION ALL {_REVISED}
            )
        ) WHERE r = 1
    """,
    "dedup_stream": "SELECT event_id, event_type FROM events",
    "read_since": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
    "new_keys": """
        SELECT * FROM orders o WHERE NOT EXISTS (
            SELECT 1 FROM orders t WHERE t.o_orderkey = o.o_orderkey AND t.o_orderkey % 3 <> 0
        )
    """,
    "upsert": _UPSERT,
    "upsert_unique_target": _UPSERT_REPEATED,
    "lineage": "SELECT event_id, true AS has_file, true AS has_times FROM events",
    "grouped_measures": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n,
               {_MONEY.format('l_quantity')} AS qty,
               {_MONEY.format('l_extendedprice')} AS price
        FROM lineitem GROUP BY 1, 2
    """,
    "time_series": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
               {_MONEY.format('o_totalprice')} AS revenue
        FROM orders GROUP BY 1
    """,
    "headline": f"""
        SELECT count(*) AS n, {_MONEY.format('o_totalprice')} AS revenue,
               count(DISTINCT o_custkey) AS customers
        FROM orders
    """,
    "top_n": f"""
        SELECT o_custkey, {_MONEY.format('o_totalprice')} AS revenue
        FROM orders GROUP BY 1 ORDER BY revenue DESC, o_custkey LIMIT 10
    """,
    "malformed_capture": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 113 <> 0 THEN o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority, o_orderkey % 113 = 0 AS is_corrupt
        FROM orders
    """,
    "events_per_day": f"""
        SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n,
               {_MONEY.format('value')} AS total
        FROM events GROUP BY 1, 2
    """,
}
