"""For each query the SQL that gives the same rows from the same tables."""

_TYPED_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

_STEP_CHAIN = """
SELECT l_orderkey, l_linenumber AS "ColumnTwo", l_linenumber * 2 AS "ColumnFour",
       l_linenumber * 4 AS "ColumnFive"
FROM lineitem
"""

_WORDS = r"""
SELECT value, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS value FROM documents)
WHERE value <> '' GROUP BY value
"""

_TOP_WORDS = f"SELECT value, cnt FROM ({_WORDS}) ORDER BY cnt DESC, value LIMIT 10"

_WINDOWS = """
SELECT date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS total
FROM events GROUP BY ALL
"""

_LATEST_PER_KEY = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

_LATEST = "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT "

# Four equal spans of the time that the events cover, numbered from 0.
_SPANS = """
WITH clock AS (SELECT *, epoch_us(ts) AS us FROM events),
ends AS (SELECT min(us) AS low, max(us) AS high FROM clock),
spans AS (
  SELECT clock.*,
         CASE WHEN us >= low + (high - low) * 3 // 4 THEN 3
              WHEN us >= low + (high - low) * 2 // 4 THEN 2
              WHEN us >= low + (high - low) // 4 THEN 1
              ELSE 0 END AS span
  FROM clock, ends
)
"""

# An error event arrives one span late. It counts if its window ends after the watermark that the
# batches before its own have set, three days behind the greatest time in them.
_LATE = f"""
{_SPANS},
arrived AS (
  SELECT event_id, event_type, date_trunc('hour', ts) AS window_start, ts,
         CASE WHEN event_type = 'error' THEN span + 1 ELSE span END AS batch
  FROM spans
),
watermarks AS (
  SELECT batch, max(max(ts)) OVER (
           ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
         ) - INTERVAL 3 DAY AS watermark
  FROM arrived GROUP BY batch
),
counted AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS total
  FROM arrived JOIN watermarks USING (batch)
  WHERE watermark IS NULL OR window_start + INTERVAL 1 HOUR > watermark
  GROUP BY ALL
)
"""

_SQUARES = """
SELECT CAST(l_linenumber AS BIGINT) * l_linenumber AS k, CAST(sum(1) AS BIGINT) AS n
FROM lineitem GROUP BY ALL
"""


def _previous(partition):
    return f"""
    SELECT event_id, user_id, epoch_us(ts) // 1000 AS current_ms,
           lag(epoch_us(ts) // 1000, 1, 0) OVER ({partition} ORDER BY ts, event_id) AS last_ms
    FROM events
    """


_PREVIOUS_BY_USER = _previous("PARTITION BY user_id")

_BATCH_OF_ORDER = "CAST(l_orderkey % 4 AS BIGINT) AS batch_id"

ORACLES = {
    "typed_map_latest": """
        SELECT event_id, ts, user_id, value, value * 2 AS doubled, value * 4 AS redoubled
        FROM events ORDER BY ts DESC, event_id DESC LIMIT 10
    """,
    "typed_map_projection": _TYPED_EVENTS,
    "typed_map_malformed": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS code,
               value, CAST(NULL AS VARCHAR) AS absent
        FROM events
    """,
    "step_chain": _STEP_CHAIN,
    "sql_step": "SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS doubled FROM orders",
    "epoch_seconds": "SELECT event_id, CAST(floor(epoch(ts)) AS INTEGER) AS now FROM events",
    "arrival_timestamp": "SELECT event_id, ts < now() AS arrived_after, CAST(0 AS INTEGER) AS hours_off FROM events",
    "word_count": _WORDS,
    "top_words": _TOP_WORDS,
    "window_count": _WINDOWS,
    "window_total": f"SELECT window_start, total FROM ({_WINDOWS})",
    "sum_of_counts": "SELECT count(*) AS sum_counts FROM events",
    "keyed_sum": _SQUARES,
    "latest_row": _LATEST + "1",
    "latest_n": _LATEST + "10",
    "latest_per_key": _LATEST_PER_KEY,
    "argmax_row": "SELECT * FROM events ORDER BY value DESC NULLS LAST, event_id DESC LIMIT 1",
    "previous_event": _PREVIOUS_BY_USER,
    "previous_event_global": _previous(""),
    "json_round_trip": "SELECT * FROM events",
    "append_rows_stream": f"""
        {_TYPED_EVENTS}
        UNION ALL SELECT -1, TIMESTAMP '2024-01-01 00:00:00', 0, 'start', 0.5, '{{}}'
        UNION ALL SELECT -2, TIMESTAMP '2024-01-01 00:00:00', 0, 'end', NULL, '{{}}'
    """,
    "append_rows_once_stream": "SELECT event_id, user_id, ts FROM events",
    "restart_stream": "SELECT event_id, user_id, ts FROM events",
    "step_chain_stream": _STEP_CHAIN,
    "word_count_stream": _WORDS,
    "top_words_stream": _TOP_WORDS,
    "window_count_stream_append": f"""
        SELECT * FROM ({_WINDOWS})
        WHERE window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)
    """,
    "window_count_stream_finished": _WINDOWS,
    "window_count_stream_update": _WINDOWS,
    "window_count_stream_complete": _WINDOWS,
    "window_count_arrival": """
        SELECT count(*) AS sum_counts, CAST(5000 AS BIGINT) AS shortest_ms, CAST(5000 AS BIGINT) AS longest_ms,
               true AS aligned, true AS around_now
        FROM events
    """,
    "late_rows_append": f"""
        {_LATE} SELECT * FROM counted
        WHERE window_end <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)
    """,
    "late_rows_finished": f"{_LATE} SELECT * FROM counted",
    "late_rows_update": f"{_LATE} SELECT * FROM counted",
    "late_rows_complete": _WINDOWS,
    "late_rows_table": f"""
        {_LATE} SELECT event_id, event_type, ts, CAST(batch AS BIGINT) AS batch_id,
               coalesce(window_start + INTERVAL 1 HOUR <= watermark, false) AS late
        FROM arrived JOIN watermarks USING (batch)
    """,
    "keyed_sum_per_batch": f"""
        SELECT batch_id, CAST(l_linenumber AS BIGINT) * l_linenumber AS k,
               CAST(sum(1) AS BIGINT) AS n
        FROM (SELECT l_linenumber, {_BATCH_OF_ORDER} FROM lineitem) GROUP BY ALL
    """,
    "batch_preview": f"""
        SELECT l_orderkey, l_linenumber, batch_id
        FROM (SELECT l_orderkey, l_linenumber, {_BATCH_OF_ORDER} FROM lineitem)
        QUALIFY row_number() OVER (
          PARTITION BY batch_id ORDER BY l_orderkey, l_linenumber
        ) <= 10
    """,
    "latest_per_key_stream": _LATEST_PER_KEY,
    "previous_event_stream": _PREVIOUS_BY_USER,
    "previous_event_global_stream": _previous(""),
    "previous_amount_stream": """
        SELECT event_id, user_id, value,
               lag(value, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_value
        FROM events
    """,
    "stream_progress": f"""
        {_SPANS} SELECT CAST(span AS BIGINT) AS batch_id, count(*) AS num_input_rows
        FROM spans GROUP BY span
    """,
    "live_vs_snapshot": f"""
        {_SPANS} SELECT 'live' AS kind, count(*) AS n FROM spans
        UNION ALL SELECT 'snapshot' AS kind, count(*) FILTER (WHERE span = 0) AS n FROM spans
    """,
}
