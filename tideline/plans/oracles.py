"""The same queries in SQL for a second engine, each written from the operator's definition."""

from __future__ import annotations

_ORIGIN = "TIMESTAMP '1970-01-01'"
_ARRIVALS = "arrivals AS (SELECT *, event_id - event_id % 64 + (event_id % 64 * 29) % 64 AS seq FROM events)"


def _bucket(size: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}, {_ORIGIN})"


def _pv_uv(size: str, label: str = "") -> str:
    start = _bucket(size)
    return (
        f"SELECT {label}{start} AS window_start, {start} + INTERVAL '{size}' AS window_end, "
        "count(user_id) AS pv, count(DISTINCT user_id) AS uv FROM events WHERE ts IS NOT NULL GROUP BY ALL"
    )


def _judged(size: str, delay: str, lateness: str = "0 seconds") -> str:
    """Arrivals with window, watermark before the row, and the late flag."""
    return f"""{_ARRIVALS},
    marked AS (SELECT *, max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL '{delay}' - INTERVAL '1 millisecond' AS wm_before,
               {_bucket(size)} AS window_start, {_bucket(size)} + INTERVAL '{size}' AS window_end FROM arrivals),
    judged AS (SELECT *, coalesce(window_end - INTERVAL '1 millisecond' + INTERVAL '{lateness}' <= wm_before, false)
               AS late FROM marked)"""


def _dedup(key: str, interval: str) -> str:
    return f"""WITH RECURSIVE chain(k, t) AS (
        SELECT {key}, min(ts) FROM events GROUP BY {key}
        UNION ALL
        SELECT c.k, min(e.ts) FROM chain c JOIN events e ON e.{key} = c.k AND e.ts >= c.t + INTERVAL '{interval}'
        GROUP BY c.k)
    SELECT min(e.event_id) AS event_id, e.{key}, e.ts FROM events e JOIN chain c ON e.{key} = c.k AND e.ts = c.t
    GROUP BY e.{key}, e.ts"""


def _words(columns: str) -> str:
    return f"""WITH lines AS (
        SELECT doc_id, regexp_replace(text, ',+$', '') AS line FROM documents
        WHERE text IS NOT NULL AND NOT regexp_matches(text, '^,+$')),
    words AS (SELECT doc_id, unnest(parts) AS word, generate_subscripts(parts, 1) - 1 AS pos
              FROM (SELECT doc_id, string_split(line, ',') AS parts FROM lines))
    {columns}"""


def _hash(text: str, factor: int) -> str:
    raw = (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), lambda c: "
        "CASE WHEN c = '' THEN 0 ELSE unicode(c) END::BIGINT)), lambda h, u: (h * 31 + u) % 4294967296)"
    )
    scaled = f"(({raw})::HUGEINT * {factor}) % 4294967296"
    return f"CASE WHEN {scaled} >= 2147483648 THEN {scaled} - 4294967296 ELSE {scaled} END"


_CENTS = """SELECT {}max(cents) AS max, min(cents) AS min, sum(cents)::BIGINT AS sum, avg(cents) AS avg, count(cents) AS counts
    FROM (SELECT *, ts::DATE::VARCHAR AS day, CASE WHEN event_id % 11 > 0 THEN round(value * 100)::BIGINT END AS cents FROM events) GROUP BY ALL"""

_TAKEN_BACK = f"""WITH {_ARRIVALS},
    e AS (SELECT user_id, seq, round(value * 100)::BIGINT AS cents, 1 AS sign FROM arrivals),
    signed AS (SELECT * FROM e
        UNION ALL SELECT user_id, seq + 50000000, cents, -1 FROM e WHERE seq % 3 = 0
        UNION ALL SELECT user_id, seq + 100000000, cents, -1 FROM e WHERE seq % 3 <> 0 AND user_id % 5 = 0),
    scanned AS (SELECT user_id, seq, sum(sign) OVER w AS n, sum(sign * cents) OVER w AS res
                FROM signed WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
    pairs AS (SELECT *, coalesce(lag(n) OVER w, 0) AS n_old, lag(res) OVER w AS old FROM scanned WINDOW w AS (PARTITION BY user_id ORDER BY seq))
    SELECT user_id, seq * 2 + 1 AS change_seq, CASE WHEN n_old = 0 THEN '+I' ELSE '+U' END AS row_kind, res::BIGINT AS result
    FROM pairs WHERE n > 0 AND (n_old = 0 OR res <> old)
    UNION ALL
    SELECT user_id, seq * 2, CASE WHEN n = 0 THEN '-D' ELSE '-U' END, old::BIGINT FROM pairs WHERE n_old > 0 AND (n = 0 OR res <> old)"""

_FIRED = f"""WITH {_ARRIVALS},
    cut AS (SELECT event_id, event_type, ts, seq, least(seq * 3 // (SELECT max(seq) + 1 FROM arrivals) + (event_id % 50 = 0)::INT, 2) AS part,
            {_bucket('6 hours')} + INTERVAL 6 HOUR AS window_end FROM arrivals),
    tops AS (SELECT part + 1 AS part, max(ts) AS top FROM cut GROUP BY part),
    marks AS (SELECT part, max(top) OVER (ORDER BY part) - INTERVAL 10 MINUTE AS mark FROM tops),
    judged AS (SELECT c.*, CASE WHEN mark IS NULL OR window_end > mark THEN 'in time'
                               WHEN window_end + INTERVAL 5 DAY > mark THEN 'late' ELSE 'gone' END AS state
               FROM cut c LEFT JOIN marks m ON c.part = m.part),
    first AS (SELECT event_type, window_end, count(*) FILTER (state = 'in time') > 0 AS timely FROM judged GROUP BY ALL),
    numbered AS (SELECT *, timely::INT + row_number() OVER (PARTITION BY event_type, window_end, state ORDER BY part, seq) AS nth
                 FROM judged JOIN first USING (event_type, window_end)),
    fires AS (SELECT event_type, window_end, nth AS firing FROM numbered WHERE state = 'late'
              UNION ALL SELECT event_type, window_end, 1 FROM first WHERE timely AND window_end <= (SELECT max(mark) FROM marks))
    SELECT event_id, event_type, window_end, firing FROM numbered JOIN fires USING (event_type, window_end)
    WHERE state = 'in time' OR (state = 'late' AND nth <= firing)
    UNION ALL SELECT event_id, event_type, window_end, 0 FROM judged WHERE state = 'gone'"""


def _idle_late() -> str:
    """Three sources; a time-out mark after every row, which counts unless the source has sent a row meanwhile."""
    hour = 3_600_000_000
    states = ", ".join(f"max(v) FILTER (source = {s}) OVER w AS v{s}, max(a) FILTER (source = {s}) OVER w AS a{s}, "
                       f"max(m) FILTER (source = {s}) OVER w AS m{s}" for s in range(3))
    known = " OR ".join(f"(a{s} IS NOT NULL AND coalesce(m{s} < a{s} + {hour}, true) AND v{s} IS NULL)" for s in range(3))
    values = ", ".join(f"CASE WHEN a{s} IS NOT NULL AND coalesce(m{s} < a{s} + {hour}, true) THEN v{s} END" for s in range(3))
    start, end = _bucket("30 minutes"), f"{_bucket('30 minutes')} + INTERVAL '30 minutes'"
    return f"""WITH sent AS (
        SELECT *, CASE WHEN event_id % 3 = 2 AND hour(ts) BETWEEN 6 AND 17 THEN 0 ELSE event_id % 3 END AS source FROM events),
    arrived AS (SELECT *, epoch_us(ts) + (event_id * 7919 % 900 + CASE WHEN source = 1 THEN 1200 ELSE 0 END) * 1000000 AS came FROM sent),
    started AS (SELECT source, min(min(came)) OVER () AS came FROM arrived GROUP BY source),
    e AS (
        SELECT came, 0 AS kind, NULL AS event_id, source, NULL AS v, came AS a, NULL AS m FROM started
        UNION ALL SELECT came, 1, event_id, source, epoch_us(ts), came, NULL FROM arrived
        UNION ALL SELECT DISTINCT came + {hour}, 2, NULL, NULL, NULL, NULL, NULL FROM (SELECT came FROM arrived UNION ALL SELECT came FROM started)
        UNION ALL SELECT DISTINCT came + {hour}, 3, NULL, source, NULL, NULL, came + {hour} FROM (SELECT came, source FROM arrived UNION ALL SELECT came, source FROM started)),
    s AS (SELECT *, {states} FROM e WINDOW w AS (ORDER BY came, kind, event_id, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT *, CASE WHEN kind IN (1, 2) AND NOT ({known}) THEN least({values}) END AS low FROM s),
    w AS (SELECT *, max(low) OVER (ORDER BY came, kind, event_id, source) AS wm FROM l),
    marked AS (SELECT event_id, w.source, make_timestamp(wm) - INTERVAL '5 minutes' - INTERVAL '1 millisecond' AS wm_before
               FROM w WHERE kind = 1)
    SELECT event_id, source::BIGINT AS source, {end} AS window_end, wm_before,
           coalesce({end} - INTERVAL '1 millisecond' + INTERVAL '5 minutes' <= wm_before, false) AS late
    FROM marked JOIN events USING (event_id)"""


_CHANGES = f"""WITH {_ARRIVALS},
    scanned AS (SELECT user_id, seq, sum(round(value * 100)::BIGINT) OVER w AS res, row_number() OVER w AS n
                FROM arrivals WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
    pairs AS (SELECT *, lag(res) OVER (PARTITION BY user_id ORDER BY seq) AS old FROM scanned),
    changes AS (
        SELECT user_id, seq * 2 + 1 AS change_seq, CASE WHEN n = 1 THEN '+I' ELSE '+U' END AS row_kind,
               res::BIGINT AS result FROM pairs WHERE n = 1 OR res IS DISTINCT FROM old
        UNION ALL
        SELECT user_id, seq * 2, '-U', old::BIGINT FROM pairs WHERE n > 1 AND res IS DISTINCT FROM old)"""

_LOG = "log AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderkey % 7 AS _commit, 'U' AS _op FROM orders)"
_NEWEST = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, _commit DESC, o_orderkey DESC)"
_ROW = "o_custkey, o_orderkey, o_totalprice, o_orderdate"


def _latest(where: str = "true", columns: str = _ROW) -> str:
    return f"WITH {_LOG} SELECT {columns} FROM (SELECT *, {_NEWEST} AS rn FROM log WHERE {where}) WHERE rn = 1"


def _ids(table: str, key: str, ms: str, worker: str) -> str:
    """Slot of a row: its index plus the running maximum of (4096 * ms - index) over its worker's rows."""
    return f"""WITH base AS (SELECT {key} AS k, {ms} AS ms, {worker} AS w FROM {table}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY ms, k) - 1 AS i FROM base),
    slotted AS (SELECT *, i + max(ms * 4096 - i) OVER (PARTITION BY w ORDER BY ms, k) AS slot FROM numbered),
    ids AS (SELECT k, w, slot // 4096 AS id_ms, slot % 4096 AS sequence,
            ((slot // 4096 - 1480166465631) * 4194304 + w * 4096 + slot % 4096)::BIGINT AS id FROM slotted)"""


_TIMED = f"""WITH RECURSIVE days AS (SELECT *, datediff('day', DATE '1992-01-01', o_orderdate::DATE) AS day FROM orders WHERE o_orderkey % 3 > 0),
    log AS (SELECT {_ROW}, day // 100 * 1000 + day % 100 // (day // 100 % 9 + 1) AS _commit FROM days),
    commits AS (SELECT _commit, max(o_orderdate) AS time, row_number() OVER (ORDER BY _commit) AS n FROM log GROUP BY _commit),
    chain(n, time) AS (
        SELECT 0::BIGINT, min(time) FROM commits
        UNION ALL
        SELECT x.n, x.time FROM chain p, LATERAL (
            SELECT c.n, c.time FROM commits c WHERE c.n >= p.n + 3 AND c.time >= p.time + INTERVAL 15 DAY ORDER BY c.n LIMIT 1) x),
    compacted AS (SELECT max(_commit) AS last FROM commits WHERE n = (SELECT max(n) FROM chain))
    SELECT {_ROW} FROM (SELECT *, {_NEWEST} AS rn FROM log WHERE _commit <= (SELECT last FROM compacted)) WHERE rn = 1"""

_EVENT_IDS = _ids("events", "event_id", "epoch_us(ts) // 1000", "user_id % 1024")
_ORDER_IDS = _ids("orders", "o_orderkey", "1704067200000 + o_orderkey % 3", "CASE WHEN o_custkey % 10 < 8 THEN 37 ELSE 38 END")


def oracles() -> dict[str, str]:
    sql = {
        "tumble_pv_uv": _pv_uv("1 hour"),
        "tumble_pv_uv_clock": f"""SELECT strftime(window_start, '%Y-%m-%d') AS day,
            strftime(window_start, '%H:%M:%S') AS start_time, strftime(window_end, '%H:%M:%S') AS end_time, pv, uv
            FROM ({_pv_uv('6 hours')})""",
        "multi_window_pv_uv": " UNION ALL ".join(
            f"({_pv_uv(size, f'{size!r} AS window_size, ')})" for size in ("1 hour", "3 hours", "7 hours", "1 day")
        ),
        "union_all_pv_uv": f"({_pv_uv('12 hours')}) UNION ALL ({_pv_uv('1 day')})",
        "cumulate_pv_uv": """WITH days AS (SELECT date_trunc('day', ts) AS d, date_trunc('hour', min(ts)) AS first FROM events GROUP BY 1),
            spine AS (SELECT d, unnest(generate_series(first + INTERVAL 1 HOUR, d + INTERVAL 1 DAY, INTERVAL 1 HOUR)) AS e FROM days)
            SELECT d AS window_start, e AS window_end, count(user_id) AS pv, count(DISTINCT user_id) AS uv
            FROM spine JOIN events ON ts >= d AND ts < e GROUP BY d, e""",
        "day_window_offset": """SELECT date_trunc('day', ts + INTERVAL 8 HOUR)::TIMESTAMP - INTERVAL 8 HOUR AS window_start,
            date_trunc('day', ts + INTERVAL 8 HOUR)::TIMESTAMP + INTERVAL 16 HOUR AS window_end,
            count(user_id) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL""",
        "window_stats": f"""SELECT event_type, {_bucket('6 hours')} AS window_start,
            {_bucket('6 hours')} + INTERVAL 6 HOUR AS window_end, max(value) AS max, min(value) AS min,
            round(sum(value), 2) AS sum, round(avg(value), 8) AS avg, count(value) AS counts FROM events GROUP BY ALL""",
        "window_rows": f"""SELECT event_id, {_bucket('5 minutes')} AS window_start,
            {_bucket('5 minutes')} + INTERVAL 5 MINUTE AS window_end FROM events""",
        "group_count": "SELECT user_id, count(value) AS count1 FROM events GROUP BY user_id",
        "hourly_report": """SELECT user_id, date_trunc('hour', ts) AS log_ts, round(sum(value), 2) AS amount
            FROM events GROUP BY ALL""",
        "tumble_count_end": f"""SELECT user_id, {_bucket('10 minutes')} + INTERVAL 10 MINUTE AS window_end,
            count(value) AS count1 FROM events GROUP BY ALL""",
        "word_count": _words("SELECT word, count(*) AS total FROM words GROUP BY word"),
        "running_word_count": _words("""SELECT doc_id, pos::INTEGER AS pos, word,
            count(*) OVER (PARTITION BY word ORDER BY doc_id, pos) AS total FROM words"""),
        "bitmap_distinct": "SELECT event_type, count(DISTINCT user_id) AS uv FROM events GROUP BY event_type",
        "bitmap_distinct_rollup": """SELECT event_type, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type
            UNION ALL SELECT 'all', count(DISTINCT event_id) FROM events""",
        "bitmap_rollup_hashed": """WITH e AS (SELECT event_type, event_id * 2654435761 % 1099511627776 AS hashed,
                CASE WHEN event_id % 4 = 0 THEN event_id + 2000000000 ELSE event_id * 2654435761 % 1099511627776 END AS mixed FROM events)
            SELECT event_type, count(DISTINCT hashed) AS ids, 'hashed' AS kind FROM e GROUP BY event_type
            UNION ALL SELECT event_type, count(DISTINCT mixed), 'mixed' FROM e GROUP BY event_type""",
        "user_aggregate": _CENTS.format("event_type, day, "),
        "user_aggregate_sql": _CENTS.format("event_type, "),
        "user_distinct": """SELECT event_type, count(DISTINCT CASE WHEN event_id % 11 > 0 THEN round(value * 100)::BIGINT END) AS uv
            FROM events GROUP BY event_type""",
        "late_split": f"""WITH {_judged('30 minutes', '10 minutes', '5 minutes')}
            SELECT event_id, window_end, wm_before, late FROM judged""",
        "late_split_strict": f"""WITH {_judged('30 minutes', '0 seconds')}
            SELECT event_id, window_end, wm_before, late FROM judged""",
        "late_split_per_event": f"""WITH {_judged('30 minutes', '0 seconds')},
            each AS (SELECT event_id, window_end, wm_before + INTERVAL '1 millisecond' AS wm_before FROM judged)
            SELECT *, coalesce(window_end - INTERVAL '1 millisecond' <= wm_before, false) AS late FROM each""",
        "read_optimized_timed": _TIMED,
        "cow_upsert": f"""SELECT {_ROW} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders) WHERE rn = 1""",
        "text_source_lines": """SELECT event_type AS k, count(*) AS n, sum(floor(value))::BIGINT AS total FROM events
            WHERE event_id % 6 > 0 GROUP BY event_type""",
        "kafka_records": """SELECT (user_id % 4)::INTEGER AS "partition", event_id AS "offset", ts AS at, user_id, event_type AS kind,
            floor(value)::BIGINT AS amount FROM events WHERE event_id % 7 > 0""",
        "processing_time_column": "SELECT count(*) AS orders, true AS now FROM orders",
        "insert_rows": "SELECT o_custkey AS customer, count(*) AS orders FROM orders GROUP BY o_custkey",
        "multi_window_stream": "SELECT * FROM (" + " UNION ALL ".join(
            _pv_uv(size, f"'{size}' AS window_size, ") for size in ("1 hour", "7 hours", "1 day")) + """)
            WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
        "declared_watermark": f"""SELECT * FROM (
                SELECT user_id, {_bucket('6 hours')} + INTERVAL 6 HOUR AS window_end, count(value) AS count1 FROM events GROUP BY ALL)
            WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
        "early_results": """WITH w AS (SELECT date_trunc('day', ts + INTERVAL 8 HOUR)::TIMESTAMP - INTERVAL 8 HOUR AS window_start,
                count(user_id) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL)
            SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, 'pv' AS measure, pv AS value FROM w
            UNION ALL SELECT window_start, window_start + INTERVAL 1 DAY, 'uv', uv FROM w""",
        "text_sink_lines": "SELECT event_id || ',' || event_type AS value FROM events",
        "upsert_sink_log": f"""SELECT {_ROW} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders) WHERE rn = 1""",
        "change_stream": """WITH p AS (SELECT *, o_orderkey * 3 // (SELECT max(o_orderkey) + 1 FROM orders) AS part FROM orders)
            SELECT o_orderkey, o_totalprice, o_orderstatus, part + 1 AS commit, CASE WHEN part = 2 THEN 'D' ELSE 'U' END AS op FROM p""",
        "changelog_stream": f"{_CHANGES} SELECT * FROM changes",
        "changelog_stream_deletes": _TAKEN_BACK,
        "fired_window_rows": _FIRED,
        "dedup_interval_stream": _dedup("user_id", "12 hours"),
        "idle_sources_late": _idle_late(),
        "late_by_arrival_time": f"""WITH numbered AS (SELECT event_id, ts, row_number() OVER (
                ORDER BY ts + to_seconds(event_id * 7919 % 3600), event_id) - 1 AS seq FROM events),
            marked AS (SELECT *, max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL '10 minutes' - INTERVAL '1 millisecond' AS wm,
                {_bucket('30 minutes')} + INTERVAL 30 MINUTE AS window_end FROM numbered)
            SELECT event_id, seq, window_end, coalesce(window_end - INTERVAL '1 millisecond' <= wm, false) AS late FROM marked""",
        "lateness_firings": f"""WITH {_judged('1 hour', '10 minutes', '4 hours')},
            kept AS (SELECT *, round(value * 100)::BIGINT AS cents,
                     coalesce(wm_before < window_end - INTERVAL '1 millisecond', true) AS in_time FROM judged WHERE NOT late),
            fired AS (
                SELECT event_type, window_start, window_end, -1 AS pos, count(*) AS n, sum(cents) AS v FROM kept
                WHERE in_time AND window_end - INTERVAL '1 millisecond' <= (SELECT max(ts) FROM events)
                      - INTERVAL '10 minutes' - INTERVAL '1 millisecond' GROUP BY ALL
                UNION ALL
                SELECT event_type, window_start, window_end, seq, 1, cents FROM kept WHERE NOT in_time)
            SELECT event_type, window_start, window_end, row_number() OVER w AS firing,
                   (sum(n) OVER w)::BIGINT AS rows, (sum(v) OVER w)::BIGINT AS total
            FROM fired WINDOW w AS (PARTITION BY event_type, window_start, window_end ORDER BY pos)""",
        "windowed_reduce": f"""WITH {_judged('6 hours', '1 hour')},
            grouped AS (SELECT event_type, window_start, window_end, list(floor(value)::BIGINT ORDER BY seq) AS vs
                        FROM judged WHERE NOT late AND event_id % 9 > 0 AND value IS NOT NULL GROUP BY ALL)
            SELECT event_type, window_start, window_end,
                   event_type || CASE WHEN len(vs) > 1 THEN '_' || array_to_string(vs[2:], '_') ELSE '' END AS label,
                   list_sum(vs)::BIGINT AS total FROM grouped""",
        "windowed_reduce_parts": f"""WITH {_judged('6 hours', '1 hour')}
            SELECT event_type, window_start, window_end, seq // 256 AS part, string_agg(floor(value)::BIGINT::VARCHAR, '_' ORDER BY seq) AS piece,
                   first(floor(value)::BIGINT::VARCHAR ORDER BY seq) AS first_value, sum(floor(value)::BIGINT)::BIGINT AS total, count(*) AS rows
            FROM judged WHERE NOT late AND event_id % 9 > 0 AND value IS NOT NULL GROUP BY ALL""",
        "distinct_per_key_hour": f"""WITH {_judged('1 hour', '10 minutes')}
            SELECT event_type, window_end AS hour_end, count(DISTINCT user_id) AS devices FROM judged
            WHERE NOT coalesce(window_end + INTERVAL '1 millisecond' < wm_before, false) GROUP BY ALL""",
        "dedup_interval": _dedup("user_id", "12 hours"),
        "dedup_interval_heavy": _dedup("event_type", "1 hour"),
        "dedup_interval_mixed": f"""WITH RECURSIVE keyed AS (
                SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END::BIGINT AS account FROM events),
            chain(k, t) AS (
                SELECT account, min(ts) FROM keyed GROUP BY account
                UNION ALL
                SELECT c.k, min(e.ts) FROM chain c JOIN keyed e ON e.account = c.k AND e.ts >= c.t + INTERVAL '2 hours' GROUP BY c.k)
            SELECT min(e.event_id) AS event_id, e.account, e.ts FROM keyed e JOIN chain c ON e.account = c.k AND e.ts = c.t
            GROUP BY e.account, e.ts""",
        "arrival_window_pv_uv": f"""WITH arrived AS (SELECT user_id, ts + to_seconds(event_id * 7919 % 3600) AS ts FROM events)
            SELECT {_bucket('1 hour')} AS window_start, {_bucket('1 hour')} + INTERVAL 1 HOUR AS window_end,
                   count(user_id) AS pv, count(DISTINCT user_id) AS uv FROM arrived GROUP BY ALL""",
        "changelog": f"{_CHANGES} SELECT * FROM changes",
        "changelog_apply": f"""{_CHANGES} SELECT user_id, result FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_seq DESC) AS rn FROM changes)
            WHERE rn = 1 AND row_kind IN ('+I', '+U')""",
        "changelog_apply_deletes": """SELECT user_id, sum(round(value * 100)::BIGINT)::BIGINT AS result FROM events
            WHERE user_id IS NULL OR user_id % 5 <> 0 GROUP BY user_id""",
        "java_hash_x12": f"SELECT event_id, ({_hash('props', 12)})::INTEGER AS hash FROM events",
        "java_hash_texts": f"""SELECT lang, sum(h)::BIGINT AS checksum, count(DISTINCT h) AS hashes
            FROM (SELECT lang, ({_hash('text', 7)})::BIGINT AS h FROM documents) GROUP BY lang""",
        "user_struct": """SELECT event_id, (event_id % 10)::INTEGER AS age,
            CASE WHEN event_id % 10 BETWEEN 1 AND 5 THEN 'name1' ELSE 'name2' END AS name,
            CASE WHEN event_id % 10 BETWEEN 1 AND 5 THEN 1.1 ELSE 2.2 END::DOUBLE AS balance,
            CASE WHEN event_id % 10 BETWEEN 1 AND 5 THEN 'name1' ELSE 'name2' END AS name_of_record FROM events""",
        "user_struct_sql": f"""WITH n AS (SELECT event_id, event_type, CASE WHEN event_id % 17 = 0 THEN 9223372036854775807
                WHEN event_id % 19 = 0 THEN -9223372036854775808 ELSE event_id % 10 END AS n FROM events)
            SELECT event_id, CASE WHEN event_id % 17 = 0 THEN -1 WHEN event_id % 19 = 0 THEN 0 ELSE n END::INTEGER AS age,
                CASE WHEN n BETWEEN 1 AND 5 THEN 'name1' ELSE 'name2' END AS name,
                CASE WHEN n BETWEEN 1 AND 5 THEN 1.1 ELSE 2.2 END::DOUBLE AS balance,
                CASE WHEN n BETWEEN 1 AND 5 THEN 'name1' ELSE 'name2' END AS name_of_record,
                ({_hash('event_type', 12)})::INTEGER AS hash FROM n""",
        "declared_table": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_day, count(o_orderkey) AS orders,
            sum(o_totalprice::DECIMAL(32, 2))::DOUBLE AS price FROM orders GROUP BY 1""",
        "parse_temperature_lines": """SELECT event_type AS province, count(DISTINCT user_id) AS cities, max(floor(value))::DOUBLE AS top,
            sum(epoch_us(date_trunc('second', ts)) // 1000)::BIGINT AS ms FROM events GROUP BY event_type""",
        "json_tolerant": """WITH raw AS (SELECT event_id, CASE
                WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1)
                WHEN event_id % 11 = 0 THEN '{"k": "x"}' WHEN event_id % 13 = 0 THEN '{"other": 1}'
                WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 'no object' WHEN event_id % 23 = 0 THEN '{"k": 2}'
                WHEN event_id % 29 = 0 THEN 'no object' ELSE props END AS value FROM events)
            SELECT event_id, TRY_CAST(CASE WHEN json_valid(value) THEN json_extract_string(value, '$.k') END AS INTEGER) AS k
            FROM raw WHERE json_valid(value)""",
        "nested_flatten": """SELECT c_custkey, split_part(c_name, '#', 1) AS first_name,
            split_part(c_name, '#', 2) AS last_name FROM customer""",
        "parse_csv_lines": """SELECT o_orderkey || '-' || o_custkey AS click_key, o_orderdate AS ts FROM orders
            WHERE o_orderstatus = 'F'""",
        "parse_pairs_tolerant": """SELECT event_type AS k, count(*) AS n, sum(event_id)::BIGINT AS total,
            make_timestamp(max(event_id)::BIGINT * 1000000) AS latest FROM events
            WHERE event_id % 5 IN (1, 4) GROUP BY event_type""",
        "interval_shift": """SELECT event_id, ts - INTERVAL 5 SECOND AS shifted, date_trunc('hour', ts) AS hour,
            epoch_us(ts) // 1000 AS epoch_ms, date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS local_ts,
            strftime(ts, '%H:%M:%S') AS time_of_day FROM events""",
        "upsert_latest": _latest(),
        "snapshot_as_of": _latest("_commit <= 2"),
        "incremental_range": _latest("_commit > 1 AND _commit <= 3", f"{_ROW}, _commit, _op"),
        "read_optimized": _latest("""_commit <= (SELECT max(c) FROM (
            SELECT c, row_number() OVER (ORDER BY c) AS n FROM (SELECT DISTINCT _commit AS c FROM log)) WHERE n % 3 = 0)"""),
        "merge_batch": _latest(),
        "merge_rows": """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, (o_orderkey % 7 > 4) DESC, o_orderkey DESC) AS rn
            FROM orders) WHERE rn = 1""",
        "bootstrap_evolve": """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
            CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS o_totalprice,
            CASE WHEN o_orderkey % 4 = 0 THEN 'again' END AS note FROM orders""",
        "delete_keys": _latest("o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
        "struct_key_upsert": f"""WITH {_LOG} SELECT a, b, o_orderkey, o_orderdate FROM (
            SELECT o_custkey % 50 AS a, o_custkey > 700 AS b, o_orderkey, o_orderdate, row_number() OVER (
                PARTITION BY o_custkey % 50, o_custkey > 700 ORDER BY o_orderdate DESC, _commit DESC, o_orderkey DESC) AS rn
            FROM log) WHERE rn = 1""",
        "snowflake_encode": f"{_EVENT_IDS} SELECT k AS event_id, id FROM ids",
        "snowflake_stream": f"{_EVENT_IDS} SELECT k AS event_id, id FROM ids",
        "snowflake_decode": f"""{_EVENT_IDS} SELECT k AS event_id, id_ms::BIGINT AS ms, w // 32 AS datacenter,
            w % 32 AS machine, sequence::BIGINT AS sequence FROM ids""",
        "snowflake_overflow": f"{_ORDER_IDS} SELECT k AS o_orderkey, id FROM ids",
    }
    return sql
