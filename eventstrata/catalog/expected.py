"""The registered queries once more as DuckDB SQL over the same tables."""

from __future__ import annotations

from eventstrata.catalog.queries import (
    ALLOWED_SECONDS,
    HISTORY_END,
    IDLE_HOURS,
    INDEX_SINCE,
    ORDER_FIELDS,
    OVERLAP_START,
    PERCENTILES,
)
from eventstrata.config import (
    EVENT_TYPES,
    LATENESS_THRESHOLD_SECONDS,
    PAYLOAD_FIELDS,
    REJECT_REASONS,
    SEMANTIC_KEY,
)
from eventstrata.operators.cohort import DAILY_COUNTS

_VOCABULARY = ", ".join(
    f"('{t.name}', {t.rank}, {str(t.terminal).lower()})" for t in EVENT_TYPES
)


def _text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


def _line(event_id: str) -> str:
    moments = {
        "event_time": "CASE WHEN k % 109 = 0 THEN 'not-a-timestamp' "
        "ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END",
        "ingested_at": "CASE WHEN k % 113 <> 0 "
        "THEN strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') END",
    }
    values = {
        **{f: f for f in PAYLOAD_FIELDS},
        **moments,
        "event_id": event_id,
        "order_id": "CASE WHEN k % 103 <> 0 THEN order_id END",
    }
    return "'{' || " + " || ',' || ".join(
        f"'\"{f}\":' || {_text(f'({values[f]})')}" for f in PAYLOAD_FIELDS
    ) + " || '}'"


_SENT = "CASE WHEN k % 107 = 0 THEN '  ' ELSE event_id END"

STREAM = f"""
vocabulary(event_type, lifecycle_rank, is_terminal) AS (VALUES {_VOCABULARY}),
facts AS (
    SELECT event_id AS k,
           'evt_' || lpad(event_id::VARCHAR, 9, '0') AS event_id,
           'ord_' || lpad((event_id // 6)::VARCHAR, 7, '0') AS order_id,
           CASE event_type
               WHEN 'signup' THEN 'ORDER_CREATED'
               WHEN 'view' THEN 'RIDER_ALLOCATED'
               WHEN 'click' THEN 'RIDER_ACCEPTED'
               WHEN 'purchase' THEN 'DELIVERED'
               ELSE ['CANCELLED', 'STARTED_PICKUP', 'TELEPORTED'][1 + event_id % 3]
           END AS event_type,
           ts AS event_time,
           ts + to_seconds(floor(value)::BIGINT) AS ingested_at,
           CASE WHEN user_id % 11 <> 0 THEN 'city_' || (user_id % 5) END AS city,
           CASE WHEN event_type <> 'signup'
                THEN 'rider_' || lpad(user_id::VARCHAR, 6, '0') END AS rider_id,
           'supplier_0' || (user_id % 8 + 1) AS supplier_id
    FROM events
),
whole AS (SELECT k, {_line(_SENT)} AS p, {_line("'dup_' || event_id")} AS q FROM facts),
payloads AS (
    SELECT k // 4096 AS shard, k * 3 + copy + 1 AS _source_row,
           'shard=' || (k // 4096) AS _source_file, p AS _raw_payload
    FROM (
        SELECT k, 0 AS copy, CASE WHEN k % 101 = 0 THEN p[1:-2] ELSE p END AS p FROM whole
        UNION ALL SELECT k, 1, p FROM whole WHERE k % 29 = 0
        UNION ALL SELECT k, 2, q FROM whole WHERE k % 50 = 0
    )
)"""

LINES = """,
written AS (
    SELECT shard, _source_row AS line, 0 AS slot,
           _raw_payload || CASE WHEN (_source_row - 1) // 3 % 7 = 0 THEN chr(13) ELSE '' END
               AS value
    FROM payloads
    UNION ALL
    SELECT shard, _source_row, slot, blank
    FROM payloads, (VALUES (1, 37, ''), (2, 41, '  '), (3, 43, chr(160)), (4, 47, chr(13)))
        AS b(slot, n, blank)
    WHERE (_source_row - 1) % 3 = 0 AND (_source_row - 1) // 3 % n = 0
)"""


def _bronze(payloads: str) -> str:
    fields = ", ".join(
        f"CASE WHEN ok THEN json_extract_string(_raw_payload, '$.{f}') END AS {f}"
        for f in PAYLOAD_FIELDS
    )
    return f""",
bronze AS (
    SELECT _source_row, _source_file, _raw_payload, ok AS _is_valid_json, {fields}
    FROM (SELECT *, json_valid(_raw_payload) AS ok FROM {payloads})
)"""


BRONZE = _bronze("payloads")

_IDS = [f for f in PAYLOAD_FIELDS if f not in ("event_time", "ingested_at")]
VALIDATED = f""",
typed AS (
    SELECT _source_row, _source_file, _raw_payload, _is_valid_json,
           {', '.join(f"nullif(trim({f}), '') AS {f}" for f in _IDS)},
           event_time AS event_time_raw, ingested_at AS ingested_at_raw,
           try_cast(event_time AS TIMESTAMPTZ)::TIMESTAMP AS event_time,
           try_cast(ingested_at AS TIMESTAMPTZ)::TIMESTAMP AS ingested_at
    FROM bronze
),
validated AS (
    SELECT *, CASE
        WHEN NOT _is_valid_json THEN 'UNPARSEABLE_JSON'
        WHEN event_id IS NULL THEN 'MISSING_EVENT_ID'
        WHEN order_id IS NULL THEN 'MISSING_ORDER_ID'
        WHEN event_type IS NULL OR event_type NOT IN (SELECT v.event_type FROM vocabulary v)
            THEN 'UNKNOWN_EVENT_TYPE'
        WHEN event_time IS NULL THEN 'INVALID_EVENT_TIME'
        WHEN ingested_at IS NULL THEN 'INVALID_INGESTED_AT'
        END AS reject_reason
    FROM typed
),
good AS (
    SELECT event_id, order_id, event_type, event_time, ingested_at, city, rider_id, supplier_id,
           md5(_raw_payload) AS _payload_md5, _source_file, _source_row
    FROM validated WHERE reject_reason IS NULL
)"""


def _exact(name: str, source: str) -> str:
    return f""",
{name} AS (
    SELECT *, count(*) OVER (PARTITION BY event_id) AS copies
    FROM {source}
    QUALIFY row_number() OVER (
        PARTITION BY event_id ORDER BY ingested_at, _payload_md5, _source_file, _source_row) = 1
)"""


EXACT = _exact("exact", "good")

_KEY = ", ".join(SEMANTIC_KEY)


def _silver(name: str, source: str) -> str:
    return f""",
{name} AS (
    SELECT *, event_time::DATE AS event_date,
           date_diff('second', event_time, ingested_at) AS lateness_seconds,
           date_diff('second', event_time, ingested_at) > {LATENESS_THRESHOLD_SECONDS} AS is_late
    FROM {source}
)"""


SILVER = f""",
semantic AS (
    SELECT * EXCLUDE (copies, _payload_md5),
           count(*) OVER same AS copies, (sum(copies) OVER same)::BIGINT AS valid_rows
    FROM exact
    WINDOW same AS (PARTITION BY {_KEY})
    QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY ingested_at, event_id) = 1
)""" + _silver("silver", "semantic")

_SILVER_COLUMNS = (
    "event_id, order_id, event_type, event_time, ingested_at, event_date, city, rider_id, "
    "supplier_id, lateness_seconds, is_late"
)


def _orders(name: str, source: str) -> str:
    firsts = ", ".join(
        f"min(event_time) FILTER (event_type = '{t.name}') AS {t.milestone}" for t in EVENT_TYPES
    )
    milestones = ", ".join(t.milestone for t in EVENT_TYPES)
    return f""",
{name} AS (
    SELECT order_id, {milestones},
           CASE WHEN delivered_at IS NULL AND cancelled_at IS NULL THEN 'OPEN'
                WHEN coalesce(delivered_at >= cancelled_at, delivered_at IS NOT NULL)
                THEN 'DELIVERED' ELSE 'CANCELLED' END AS final_status,
           allocation_attempts, unique_riders, coalesce(created_city, any_city) AS city,
           supplier_id, event_count
    FROM (
        SELECT order_id, {firsts},
               count(*) FILTER (event_type = 'RIDER_ALLOCATED') AS allocation_attempts,
               count(DISTINCT rider_id) FILTER (event_type = 'RIDER_ALLOCATED') AS unique_riders,
               arg_min(city, (event_time, lifecycle_rank, event_id))
                   FILTER (event_type = 'ORDER_CREATED' AND city IS NOT NULL) AS created_city,
               arg_min(city, (event_time, lifecycle_rank, event_id))
                   FILTER (city IS NOT NULL) AS any_city,
               arg_max(supplier_id, (event_time, lifecycle_rank, event_id))
                   FILTER (supplier_id IS NOT NULL) AS supplier_id,
               count(*) AS event_count
        FROM {source} JOIN vocabulary USING (event_type)
        GROUP BY order_id
    )
)"""


ORDERS = _orders("orders_now", "silver")


def _daily(name: str, source: str) -> str:
    return f""",
{name} AS (
    SELECT *, orders_delivered::DOUBLE / nullif(orders_created, 0) AS fulfilment_rate,
           orders_accepted::DOUBLE / nullif(orders_allocated, 0) AS acceptance_rate
    FROM (
        SELECT created_at::DATE AS date, count(*) AS orders_created,
               count(*) FILTER (final_status = 'DELIVERED') AS orders_delivered,
               count(*) FILTER (final_status = 'CANCELLED') AS orders_cancelled,
               count(first_allocated_at) AS orders_allocated,
               count(accepted_at) AS orders_accepted,
               avg(allocation_attempts) AS avg_allocation_attempts
        FROM {source} WHERE created_at IS NOT NULL GROUP BY 1
    )
)"""


DAILY = _daily("daily", "orders_now")

_TO_VALIDATED = STREAM + BRONZE + VALIDATED
_TO_EXACT = _TO_VALIDATED + EXACT
_TO_SILVER = _TO_EXACT + SILVER
_TO_ORDERS = _TO_SILVER + ORDERS
_TO_DAILY = _TO_ORDERS + DAILY

_COUNTED = """,
landed AS (
    SELECT count(*) AS raw_events, count(reject_reason) AS rejected_events,
           count(*) FILTER (reject_reason IS NULL) AS valid_events
    FROM validated
),
lost AS (
    SELECT count(*) AS silver_events, count(*) FILTER (is_late) AS late_events,
           (SELECT count(*) FROM good) - (SELECT count(*) FROM exact)
               AS exact_duplicates_removed,
           (SELECT count(*) FROM exact) - count(*) AS semantic_duplicates_removed,
           (SELECT count(*) FROM good) - count(*) AS duplicate_events_removed
    FROM silver
)"""
_ORDER_COUNTED = """,
finished AS (
    SELECT count(*) AS unique_orders,
           count(*) FILTER (final_status = 'DELIVERED') AS delivered_orders,
           count(*) FILTER (final_status = 'CANCELLED') AS cancelled_orders,
           count(*) FILTER (final_status = 'OPEN') AS open_orders,
           count(*) FILTER (created_at IS NULL) AS orders_missing_created_at,
           (SELECT count(*) FROM daily) AS reporting_days
    FROM orders_now
)"""


def _metrics(**columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS metric, {c}::DOUBLE AS value FROM {table}"
        for table, names in columns.items()
        for c in names.split()
    )


def _q(chain: str, select: str) -> str:
    return f"WITH {chain.strip()}\n{select}"


def _differences(key: str, fields: tuple[str, ...], actual: str, expected: str) -> str:
    parts = [
        f"""SELECT coalesce(a.{key}, e.{key}) AS {key},
            CASE WHEN a.{key} IS NULL THEN 'expected only'
                 WHEN e.{key} IS NULL THEN 'actual only' ELSE 'both' END AS side,
            '{f}' AS field, e.{f}::VARCHAR AS expected, a.{f}::VARCHAR AS actual
        FROM {actual} a FULL JOIN {expected} e ON a.{key} = e.{key}
        WHERE a.{f} IS DISTINCT FROM e.{f}"""
        for f in fields
    ]
    return " UNION ALL ".join(parts)


def _membership(keys: str, actual: str, expected: str) -> str:
    return f"""
        SELECT *, 'actual only' AS side
        FROM (SELECT {keys} FROM {actual} EXCEPT SELECT {keys} FROM {expected})
        UNION ALL
        SELECT *, 'expected only' AS side
        FROM (SELECT {keys} FROM {expected} EXCEPT SELECT {keys} FROM {actual})"""


def _fingerprint() -> str:
    plain = {
        **{t.milestone: f"epoch_us({t.milestone})" for t in EVENT_TYPES},
        **{c: c for c in ("order_id", *ORDER_FIELDS)},
    }
    cells = ", ".join(
        f"coalesce('=' || replace(({plain[c]})::VARCHAR, '|', '||'), '~')" for c in sorted(plain)
    )
    return f"""SELECT count(*) AS row_count,
        sum(('0x' || substr(md5(concat_ws('|', {cells})), 1, 15))::BIGINT)::VARCHAR AS digest_sum
        FROM orders_now"""


_HISTORY = f"TIMESTAMP '{HISTORY_END}'"
_LINEAGE = "_source_file, _source_row"


def expected_sql() -> dict[str, str]:
    firsts = ", ".join(
        f"min(event_time) FILTER (event_type = '{t.name}') AS {t.milestone}" for t in EVENT_TYPES
    )
    nonblank = "SELECT *, trim(value, chr(13)) AS _raw_payload FROM written " \
        "WHERE length(trim(trim(value, chr(13)))) > 0"
    numbered = f""",
numbered AS (
    SELECT shard, _raw_payload, 'shard=' || shard AS _source_file,
           row_number() OVER (PARTITION BY shard ORDER BY line, slot) AS _source_row
    FROM ({nonblank})
)"""
    landed = STREAM + LINES + numbered + _bronze("numbered")
    landed_silver = landed + VALIDATED + EXACT + SILVER
    sql = {
        "bronze_scan": _q(
            STREAM + LINES,
            "SELECT shard, md5(value) AS line_digest, length(value) AS chars FROM written",
        ),
        "bronze_crlf_trim": _q(
            STREAM + LINES,
            "SELECT shard, trim(value, chr(13)) AS _raw_payload, "
            "contains(value, chr(13)) AS stripped FROM written",
        ),
        "bronze_nonblank_filter": _q(
            STREAM + LINES, f"SELECT shard, _raw_payload FROM ({nonblank})"
        ),
        "bronze_source_file": _q(
            STREAM + LINES,
            f"SELECT shard, 1::BIGINT AS files, 0::BIGINT AS not_below_input, "
            f"count(*) AS payloads FROM ({nonblank}) GROUP BY shard",
        ),
        "bronze_source_row": _q(
            STREAM + LINES + numbered, "SELECT shard, _source_row, _raw_payload FROM numbered"
        ),
        "bronze_events": _q(
            STREAM + LINES + numbered + _bronze("numbered"), "SELECT * FROM bronze"
        ),
        "ref_event_types": _q(
            STREAM,
            "SELECT v.*, n.events FROM vocabulary v LEFT JOIN "
            "(SELECT event_type, count(*) AS events FROM facts GROUP BY 1) n USING (event_type)",
        ),
        "json_valid_flag": _q(STREAM + BRONZE, f"SELECT {_LINEAGE}, _is_valid_json FROM bronze"),
        "json_field_extract": _q(
            STREAM + BRONZE, f"SELECT {_LINEAGE}, {', '.join(PAYLOAD_FIELDS)} FROM bronze"
        ),
        "normalize_identifiers": _q(
            _TO_VALIDATED, f"SELECT {_LINEAGE}, {', '.join(_IDS)} FROM typed"
        ),
        "parse_timestamps": _q(
            _TO_VALIDATED,
            f"SELECT {_LINEAGE}, event_time_raw, ingested_at_raw, event_time, ingested_at "
            "FROM typed",
        ),
        "vocab_left_join": _q(
            _TO_VALIDATED,
            f"SELECT {_LINEAGE}, t.event_type, v.lifecycle_rank FROM typed t "
            "LEFT JOIN vocabulary v ON v.event_type = t.event_type",
        ),
        "validate_events": _q(_TO_VALIDATED, "SELECT * FROM validated"),
        "quarantine_events": _q(
            _TO_VALIDATED,
            "SELECT * EXCLUDE (_is_valid_json, event_time, ingested_at) FROM validated "
            "WHERE reject_reason IS NOT NULL",
        ),
        "valid_events": _q(_TO_VALIDATED, "SELECT * FROM good"),
        "dedup_exact": _q(_TO_EXACT, "SELECT * EXCLUDE (_payload_md5) FROM exact"),
        "dedup_semantic": _q(_TO_SILVER, "SELECT * FROM semantic"),
        "keep_first_lineitem": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                   count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) = 1""",
        "silver_events": _q(_TO_SILVER, f"SELECT {_SILVER_COLUMNS}, {_LINEAGE} FROM silver"),
        "silver_sorted": _q(
            _TO_SILVER,
            f"SELECT {_SILVER_COLUMNS}, {_LINEAGE} FROM silver "
            "ORDER BY order_id, event_time, event_id",
        ),
        "lateness_seconds": _q(
            _TO_SILVER, "SELECT event_id, event_time, ingested_at, lateness_seconds FROM silver"
        ),
        "late_events": _q(
            _TO_SILVER,
            "SELECT event_id, order_id, event_date, lateness_seconds FROM silver WHERE is_late",
        ),
        "lifecycle_rank_join": _q(
            _TO_SILVER,
            "SELECT event_id, event_type, lifecycle_rank FROM silver "
            "JOIN vocabulary USING (event_type)",
        ),
        "order_milestones": _q(
            _TO_SILVER, f"SELECT order_id, {firsts} FROM silver GROUP BY order_id"
        ),
        "allocation_attempts": _q(_TO_ORDERS, "SELECT order_id, allocation_attempts FROM orders_now"),
        "unique_riders": _q(
            _TO_SILVER,
            "SELECT order_id, count(DISTINCT rider_id) AS unique_riders FROM silver "
            "WHERE event_type = 'RIDER_ALLOCATED' AND rider_id IS NOT NULL GROUP BY order_id",
        ),
        "order_city": _q(_TO_ORDERS, "SELECT order_id, city FROM orders_now"),
        "order_latest_supplier": _q(_TO_ORDERS, "SELECT order_id, supplier_id FROM orders_now"),
        "order_event_count": _q(
            _TO_SILVER, "SELECT order_id, count(*) AS event_count FROM silver GROUP BY order_id"
        ),
        "order_final_status": _q(
            _TO_ORDERS, "SELECT order_id, delivered_at, cancelled_at, final_status FROM orders_now"
        ),
        "gold_orders": _q(_TO_ORDERS, "SELECT * FROM orders_now"),
        "orders_by_status": _q(
            _TO_ORDERS, "SELECT final_status, count(*) AS orders FROM orders_now GROUP BY 1"
        ),
        "orders_missing_created_at": _q(
            _TO_ORDERS,
            "SELECT count(*) AS orders_missing_created_at FROM orders_now "
            "WHERE created_at IS NULL",
        ),
        "orders_grain_check": _q(
            _TO_ORDERS,
            "SELECT count(*) AS total_rows, count(DISTINCT order_id) AS distinct_keys, "
            "count(*) FILTER (order_id IS NULL) AS null_keys FROM orders_now",
        ),
        "status_contradictions": _q(
            _TO_ORDERS,
            """SELECT count(*) AS orders,
                count(*) FILTER (final_status NOT IN ('DELIVERED', 'CANCELLED', 'OPEN'))
                    AS unknown_status,
                count(*) FILTER (CASE final_status
                    WHEN 'DELIVERED' THEN delivered_at IS NULL
                    WHEN 'CANCELLED' THEN cancelled_at IS NULL
                    ELSE coalesce(delivered_at, cancelled_at) IS NOT NULL END)
                    AS contradictions FROM orders_now""",
        ),
        "rider_attempt_check": _q(
            _TO_ORDERS,
            "SELECT count(*) AS orders, "
            "count(*) FILTER (unique_riders > allocation_attempts) AS violations FROM orders_now",
        ),
        "daily_counts": _q(_TO_DAILY, f"SELECT date, {', '.join(DAILY_COUNTS)} FROM daily"),
        "avg_allocation_attempts": _q(
            _TO_DAILY, "SELECT date, avg_allocation_attempts FROM daily"
        ),
        "null_safe_rates": _q(
            _TO_DAILY, "SELECT date, fulfilment_rate, acceptance_rate FROM daily"
        ),
        "daily_metrics": _q(_TO_DAILY, "SELECT * FROM daily"),
        "daily_total_created": _q(
            _TO_DAILY, "SELECT sum(orders_created)::BIGINT AS total_created FROM daily"
        ),
        "rate_domain_check": _q(
            _TO_DAILY,
            """SELECT count(*) AS days,
                count(*) FILTER (fulfilment_rate < 0 OR fulfilment_rate > 1)
                    AS fulfilment_outside,
                count(*) FILTER (acceptance_rate < 0 OR acceptance_rate > 1)
                    AS acceptance_outside FROM daily""",
        ),
        "cohort_rates_orders": """
            SELECT o_orderdate::DATE AS date, count(*) AS orders,
                   count(*) FILTER (o_orderstatus = 'F')::DOUBLE / count(*) AS shipped_rate,
                   count(*) FILTER (o_orderstatus = 'F')::DOUBLE
                       / nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0)
                       AS shipped_per_urgent
            FROM orders GROUP BY 1""",
        "rejections_by_reason": _q(
            _TO_VALIDATED,
            "SELECT reject_reason, count(*) AS events FROM validated "
            "WHERE reject_reason IS NOT NULL GROUP BY 1",
        ),
        "layer_counts": _q(
            _TO_DAILY + _COUNTED + _ORDER_COUNTED,
            _metrics(
                landed="raw_events rejected_events valid_events",
                lost="silver_events duplicate_events_removed late_events",
                finished="unique_orders orders_missing_created_at reporting_days",
            ),
        ),
        "reconciliation": _q(
            _TO_SILVER + _COUNTED,
            """SELECT raw_events,
                silver_events + rejected_events + duplicate_events_removed AS accounted_events,
                raw_events = silver_events + rejected_events + duplicate_events_removed
                    AS balanced FROM landed, lost""",
        ),
        "duplicates_by_class": _q(
            _TO_SILVER + _COUNTED,
            "SELECT exact_duplicates_removed, semantic_duplicates_removed, "
            "duplicate_events_removed FROM lost",
        ),
        "late_event_rate": _q(
            _TO_SILVER + _COUNTED,
            "SELECT silver_events, late_events, "
            "late_events::DOUBLE / nullif(silver_events, 0) AS late_event_rate FROM lost",
        ),
        "quarantine_completeness": _q(
            _TO_VALIDATED,
            "SELECT count(*) AS rejected_rows, count(*) FILTER (_raw_payload IS NULL) "
            "AS incomplete_rows FROM validated WHERE reject_reason IS NOT NULL",
        ),
        "daily_vs_orders_diff": _q(
            _TO_DAILY
            + _orders("orders_on_time", "(FROM silver WHERE NOT is_late)")
            + _daily("daily_on_time", "orders_on_time"),
            _differences("date", DAILY_COUNTS, "daily", "daily_on_time"),
        ),
        "orders_field_diff": _q(
            _TO_ORDERS + _orders("orders_naive", "exact"),
            _differences("order_id", ORDER_FIELDS, "orders_now", "orders_naive"),
        ),
        "orders_membership_diff": _q(
            _TO_ORDERS,
            _membership(
                "order_id",
                "(FROM orders_now WHERE created_at IS NOT NULL)",
                "(FROM facts WHERE event_type = 'ORDER_CREATED')",
            ),
        ),
        "silver_key_diff": _q(_TO_SILVER, _membership(_KEY, "silver", "facts")),
        "table_fingerprint": _q(_TO_ORDERS, _fingerprint()),
        "parquet_roundtrip": _q(
            _TO_SILVER,
            "SELECT order_id, event_id, event_time FROM silver WHERE event_type = 'DELIVERED'",
        ),
        "sink_silver_roundtrip": _q(
            _TO_SILVER, f"SELECT {_SILVER_COLUMNS}, {_LINEAGE} FROM silver"
        ),
        "sink_partitioned_roundtrip": _q(
            _TO_SILVER, f"SELECT {_SILVER_COLUMNS}, {_LINEAGE} FROM silver"
        ),
        "published_bronze": _q(
            landed, f"SELECT *, row_number() OVER (ORDER BY {_LINEAGE}) - 1 AS position FROM bronze"
        ),
        "published_silver": _q(
            landed_silver,
            f"SELECT {_SILVER_COLUMNS}, {_LINEAGE}, "
            "row_number() OVER (ORDER BY order_id, event_time, event_id) - 1 AS position FROM silver",
        ),
        "published_quarantine": _q(
            landed + VALIDATED,
            "SELECT * EXCLUDE (_is_valid_json, event_time, ingested_at), "
            f"row_number() OVER (ORDER BY {_LINEAGE}) - 1 AS position "
            "FROM validated WHERE reject_reason IS NOT NULL",
        ),
        "physical_order": _q(
            _TO_ORDERS,
            " UNION ALL ".join(
                f"SELECT '{layer}' AS layer, count(*) AS rows, 0::BIGINT AS unordered_rows, "
                f"0::BIGINT AS unordered_parts FROM {source}"
                for layer, source in (
                    ("bronze", "bronze"),
                    ("quarantine", "validated WHERE reject_reason IS NOT NULL"),
                    ("silver", "silver"),
                    ("orders", "orders_now"),
                )
            ),
        ),
        "published_orders": _q(_TO_ORDERS, "SELECT * FROM orders_now"),
        "published_generation": _q(
            _TO_ORDERS, "SELECT *, 2::INTEGER AS generation, true AS moved FROM orders_now"
        ),
        "published_daily": _q(_TO_DAILY, "SELECT * FROM daily"),
        "run_report": _q(
            _TO_DAILY + _COUNTED + _ORDER_COUNTED,
            _metrics(
                landed="raw_events rejected_events",
                lost="silver_events duplicate_events_removed late_events "
                "exact_duplicates_removed semantic_duplicates_removed",
                finished="unique_orders delivered_orders cancelled_orders open_orders "
                "orders_missing_created_at reporting_days",
            )
            + """ UNION ALL SELECT 'late_event_rate',
                late_events::DOUBLE / nullif(silver_events, 0) FROM lost
            UNION ALL SELECT reject_reason, count(*)::DOUBLE FROM validated
            WHERE reject_reason IS NOT NULL GROUP BY 1""",
        ),
        "incremental_dedup_anti": _q(
            _TO_VALIDATED
            + _exact("history", f"(FROM good WHERE ingested_at < {_HISTORY})")
            + _exact("batch", f"(FROM good WHERE ingested_at >= TIMESTAMP '{OVERLAP_START}')"),
            "SELECT event_id, order_id, event_type, event_time, copies FROM batch "
            "WHERE event_id NOT IN (SELECT event_id FROM history "
            f"WHERE event_time::DATE >= DATE '{INDEX_SINCE}')",
        ),
        "restate_affected_dates": _q(
            _TO_SILVER, f"SELECT {_SILVER_COLUMNS}, {_LINEAGE} FROM silver"
        ),
        "gold_orders_incremental": _q(_TO_ORDERS, "SELECT * FROM orders_now"),
        "daily_metrics_incremental": _q(_TO_DAILY, "SELECT * FROM daily"),
        "quarantine_replay": _q(
            _TO_VALIDATED,
            f"""SELECT {_LINEAGE}, event_id, event_type,
                CASE WHEN reject_reason = 'UNKNOWN_EVENT_TYPE' AND event_type = 'TELEPORTED'
                     THEN CASE WHEN event_time IS NULL THEN 'INVALID_EVENT_TIME'
                               WHEN ingested_at IS NULL THEN 'INVALID_INGESTED_AT' END
                     ELSE reject_reason END AS reject_reason
            FROM validated WHERE reject_reason IS NOT NULL""",
        ),
        "stuck_orders": _q(
            _TO_ORDERS,
            f"""SELECT o.order_id, created_at, last_event_at, allocation_attempts, event_count
            FROM orders_now o JOIN (SELECT order_id, max(event_time) AS last_event_at
                FROM silver GROUP BY 1) l ON l.order_id = o.order_id
            WHERE final_status = 'OPEN' AND last_event_at
                < (SELECT max(least(event_time, ingested_at)) FROM silver) - INTERVAL {IDLE_HOURS} HOUR""",
        ),
        "lateness_percentiles": _q(
            _TO_SILVER,
            """SELECT event_type, count(*) AS events,
                quantile_disc(lateness_seconds, 0.5) AS p50,
                quantile_disc(lateness_seconds, 0.9) AS p90,
                quantile_disc(lateness_seconds, 0.99) AS p99
            FROM silver GROUP BY 1""",
        ),
        "quality_monitor_daily": _q(
            _TO_SILVER,
            """SELECT event_date, count(*) AS silver_events,
                (sum(valid_rows) - sum(copies))::BIGINT AS exact_removed,
                (sum(copies) - count(*))::BIGINT AS semantic_removed,
                (sum(valid_rows) - sum(copies))::DOUBLE / sum(valid_rows) AS exact_rate,
                (sum(copies) - count(*))::DOUBLE / sum(valid_rows) AS semantic_rate,
                count(*) FILTER (is_late)::DOUBLE / count(*) AS late_rate,
                max(ingested_at) AS newest_arrival, max(lateness_seconds) AS worst_lag
            FROM silver GROUP BY 1""",
        ),
        "reject_rates_daily": _q(
            _TO_VALIDATED,
            """SELECT event_date, reject_reason, rejected_rows, "rows", rejected_rows / "rows" AS reject_rate
            FROM (SELECT coalesce(event_time, ingested_at)::DATE AS event_date, reject_reason,
                    count(*) AS rejected_rows,
                    sum(count(*)) OVER (PARTITION BY coalesce(event_time, ingested_at)::DATE)::BIGINT AS "rows"
                FROM validated GROUP BY 1, 2)
            WHERE reject_reason IS NOT NULL""",
        ),
        "attempts_distribution": _q(
            _TO_ORDERS,
            "SELECT allocation_attempts, count(*) AS orders FROM orders_now GROUP BY 1",
        ),
        "layer_referential_check": _q(
            _TO_DAILY,
            """SELECT
                count(*) FILTER (o.order_id IS NULL) AS silver_without_order,
                count(*) FILTER (s.order_id IS NULL) AS order_without_silver,
                count(*) FILTER (s.n <> o.event_count) AS event_count_mismatch,
                count(*) FILTER (allocation_attempts < 0 OR event_count < 1) AS bad_counters,
                count(created_at) - (SELECT sum(orders_created)::BIGINT FROM daily)
                    AS unreported_orders
            FROM orders_now o FULL JOIN (SELECT order_id, count(*) AS n FROM silver GROUP BY 1) s
            ON s.order_id = o.order_id""",
        ),
        "approx_duplicate_rate": _q(
            _TO_VALIDATED,
            "SELECT count(*) AS valid_events, true AS estimate_is_near, "
            "(count(*) - count(DISTINCT event_id)) / count(*) < 0.15 AS rate_is_plausible FROM good",
        ),
        "distinct_ids_daily": _q(
            _TO_VALIDATED,
            "SELECT event_time::DATE AS event_date, count(*) AS rows, count(DISTINCT event_id) AS ids, "
            "0::BIGINT AS times_bound FROM good GROUP BY GROUPING SETS ((event_time::DATE), ())",
        ),
        "lateness_sketch_ranks": _q(
            _TO_VALIDATED,
            "SELECT event_type, count(*) AS rows, share::DOUBLE AS share, 0::BIGINT AS times_bound "
            f"FROM good, (VALUES {', '.join(f'({p})' for p in PERCENTILES)}) AS s(share) GROUP BY event_type, share",
        ),
        "stream_validate": _q(
            _TO_VALIDATED,
            "SELECT event_id, order_id, event_type, event_time, ingested_at, reject_reason "
            "FROM validated",
        ),
        "stream_dedup": _q(_TO_SILVER, f"SELECT {_KEY} FROM silver"),
        "stream_dedup_state": _q(_TO_SILVER, f"SELECT {_KEY} FROM silver"),
        "late_side_output": _q(
            _TO_VALIDATED + _silver("timed", "good"),
            "SELECT event_id, order_id, lateness_seconds, CASE WHEN "
            f"lateness_seconds > {ALLOWED_SECONDS} THEN 'late' ELSE 'on time' END AS side "
            "FROM timed",
        ),
    }
    sql["orders_printed_diff"] = sql["orders_field_diff"]
    for code in REJECT_REASONS:
        sql[f"reject_{code.lower()}"] = _q(
            _TO_VALIDATED,
            f"SELECT {_LINEAGE}, event_id, order_id, event_type, _raw_payload FROM validated "
            f"WHERE reject_reason = '{code}'",
        )
    return sql
