"""The registered queries in SQL, over the supplied tables, for an independent engine."""

from __future__ import annotations

# Ticks as the events table holds them.
_TICKS = """ticks AS (
  SELECT event_type AS ticker, value AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS volume, ts,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         epoch_us(ts) / 1e6 AS seconds
  FROM events)"""

# Ticks whose time has been through a message: epoch seconds as a double, cut to microseconds.
_SENT = f"""{_TICKS}, sent AS (
  SELECT ticker, price, volume, seconds,
         make_timestamp(CAST(trunc(seconds * 1e6) AS BIGINT)) AS ts FROM ticks)"""

# What becomes of the damaged messages.
_DRIFT = f"""{_SENT}, drift AS (
  SELECT ticker, price, volume, ts, seconds, price > 10 AS high,
         CASE WHEN ticker = 'error' THEN 'malformed'
              WHEN ticker = 'view' AND price > 10 THEN 'malformed'
              WHEN ticker = 'view' THEN 'no_price'
              WHEN ticker = 'signup' AND price > 10 THEN 'no_ticker'
              WHEN ticker = 'signup' THEN 'malformed'
              WHEN ticker = 'purchase' AND price > 10 THEN 'no_time' END AS reason
  FROM sent)"""

_FILES = """files AS (
  SELECT 'tick-lake/' ||
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE
           'year=' || year(o_orderdate) || '/month=' || month(o_orderdate) ||
           '/day=' || day(o_orderdate) || '/' END ||
         'part-' || o_orderkey || '.parquet' AS key,
         CAST(round(o_totalprice * 100) AS BIGINT) AS size,
         o_orderdate AS last_modified, o_orderstatus, o_orderpriority
  FROM orders),
labelled AS (
  SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 'ungrouped' ELSE
           'year=' || year(last_modified) || '/month=' || month(last_modified) ||
           '/day=' || day(last_modified) END AS label FROM files)"""

_REDUCTION = f"""{_FILES},
b AS (SELECT label, count(*) AS files_before FROM labelled WHERE o_orderstatus <> 'P' GROUP BY label),
a AS (SELECT label, count(*) AS n FROM labelled WHERE o_orderstatus = 'O' GROUP BY label),
r AS (
  SELECT b.label, files_before, coalesce(n, 0) AS files_after,
         round(CAST(files_before - coalesce(n, 0) AS DOUBLE) / files_before * 100, 6) AS reduction_pct
  FROM b LEFT JOIN a ON b.label = a.label)"""

_WINDOW = """ticker, count(*) AS total_records, round(avg(price), 6) AS avg_price,
  min(price) AS min_price, max(price) AS max_price"""

_HOURS = f"""{_TICKS}, hours AS (
  SELECT year, month, day, hour, count(*) AS n_rows,
         count(DISTINCT CASE WHEN date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM ticks)
                             THEN 0 WHEN ticker = 'signup' THEN 1 ELSE 2 END) AS n_files
  FROM ticks GROUP BY ALL)"""

_COLUMNS = "ticker, price, volume, ts, year, month, day, hour"
_PARTS = """CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour"""
_NEWEST = "ts DESC, ticker, price DESC, volume DESC"

ORACLES: dict[str, str] = {
    # aggregates
    "ticker_summary": f"""WITH {_TICKS}
        SELECT ticker, count(*) AS total_records, round(avg(price), 6) AS avg_price,
               min(price) AS min_price, max(price) AS max_price
        FROM ticks GROUP BY ticker ORDER BY avg_price DESC""",
    "avg_price_by_ticker": f"""WITH {_TICKS}
        SELECT ticker, round(avg(price), 6) AS avg_price FROM ticks GROUP BY ticker""",
    "avg_price_by_hour_ticker": f"""WITH {_TICKS}
        SELECT any_value(hour) AS hour, ticker, round(avg(price), 6) AS avg_price
        FROM ticks GROUP BY ticks.hour, ticker ORDER BY 1, 2""",
    "record_count_by_ticker": f"""WITH {_TICKS}
        SELECT ticker, count(*) AS num_records FROM ticks GROUP BY ticker
        ORDER BY num_records DESC, ticker""",
    "top_tickers_by_count": f"""WITH {_TICKS}
        SELECT ticker, count(*) AS num_records FROM ticks GROUP BY ticker
        ORDER BY num_records DESC, ticker LIMIT 3""",
    "daily_avg_price": f"""WITH {_TICKS}
        SELECT CAST(ts AS DATE) AS dt, round(avg(price), 6) AS avg_price
        FROM ticks WHERE ticker = 'purchase' GROUP BY CAST(ts AS DATE) ORDER BY dt""",
    "price_trend": f"""WITH {_TICKS}
        SELECT ticker, ts, round(avg(price), 6) AS price FROM ticks
        WHERE ticker IS NOT NULL AND ts IS NOT NULL GROUP BY ticker, ts""",
    "ticker_kpis": f"""WITH {_TICKS}
        SELECT ticker, round(avg(price), 6) AS avg_price, min(price) AS min_price,
               max(price) AS max_price FROM ticks GROUP BY ticker""",
    "ticker_kpis_selected": f"""WITH {_TICKS}
        SELECT ticker, round(avg(price), 6) AS avg_price, min(price) AS min_price,
               max(price) AS max_price FROM ticks WHERE ticker = 'purchase' GROUP BY ticker""",
    "ticker_list": f"WITH {_TICKS} SELECT DISTINCT ticker FROM ticks WHERE ticker IS NOT NULL",
    "ticker_list_with_null": f"""WITH {_TICKS}
        SELECT DISTINCT CASE WHEN ticker <> 'error' THEN ticker END AS ticker FROM ticks""",
    "tick_count": f"""WITH {_TICKS}
        SELECT count(*) AS total_records, count(*) = 0 AS is_empty FROM ticks""",
    "ticks_by_partition": f"""WITH {_TICKS}
        SELECT year, month, day, hour, count(*) AS total_records
        FROM ticks GROUP BY year, month, day, hour""",
    # newest rows, tails, bands
    "latest_ticks": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks ORDER BY {_NEWEST} LIMIT 5",
    "latest_ticks_by_path": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks ORDER BY {_NEWEST} LIMIT 5",
    "latest_ticks_recent": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks ORDER BY {_NEWEST} LIMIT 5",
    "ticker_tail": f"""WITH {_TICKS}
        SELECT {_COLUMNS}, CAST(row_number() OVER (
                 PARTITION BY ticker ORDER BY ts DESC, price DESC, volume DESC) AS INTEGER) AS rank
        FROM ticks QUALIFY rank <= 20""",
    "ticker_tail_selected": f"""WITH {_TICKS}
        SELECT {_COLUMNS}, CAST(row_number() OVER (
                 PARTITION BY ticker ORDER BY ts DESC, price DESC, volume DESC) AS INTEGER) AS rank
        FROM ticks WHERE ticker = 'purchase' QUALIFY rank <= 20""",
    "ticker_tail_long": f"""WITH {_TICKS}
        SELECT {_COLUMNS}, CAST(row_number() OVER (
                 PARTITION BY ticker ORDER BY ts DESC, price DESC, volume DESC) AS INTEGER) AS rank
        FROM ticks QUALIFY rank <= 5000""",
    "price_bands": f"""WITH {_TICKS}
        SELECT {_COLUMNS}, round(avg(price) OVER (PARTITION BY ticker), 6) AS avg_price,
               min(price) OVER (PARTITION BY ticker) AS min_price,
               max(price) OVER (PARTITION BY ticker) AS max_price FROM ticks""",
    "preview": f"WITH {_TICKS} SELECT ticker, price, ts, volume FROM ticks ORDER BY ts, ticker LIMIT 20",
    # parsing
    "parse_wire_messages": f"WITH {_SENT} SELECT ticker, price, volume, seconds AS timestamp FROM sent",
    "parse_drifting_messages": f"""WITH {_DRIFT}
        SELECT CASE WHEN ticker = 'error' OR (ticker = 'signup' AND high) THEN NULL ELSE ticker END AS ticker,
               CASE WHEN ticker IN ('error', 'view') THEN NULL ELSE price END AS price,
               CASE WHEN ticker = 'error' OR (ticker = 'signup' AND NOT high) THEN NULL ELSE volume END AS volume,
               CASE WHEN ticker = 'error' OR (ticker = 'purchase' AND high) THEN NULL ELSE seconds END AS timestamp
        FROM drift""",
    "partition_wire_messages": f"WITH {_SENT} SELECT ticker, price, volume, ts, {_PARTS} FROM sent",
    "good_ticks": f"""WITH {_DRIFT}
        SELECT ticker, price, volume, seconds AS timestamp FROM drift WHERE reason IS NULL""",
    "quarantined_messages": f"""WITH {_DRIFT}
        SELECT reason, count(*) AS n_messages FROM drift WHERE reason IS NOT NULL GROUP BY reason""",
    "normalize_epoch_time": f"WITH {_SENT} SELECT ticker, price, volume, ts FROM sent",
    "normalize_text_time": "SELECT o_orderkey, o_orderdate AS ts FROM orders",
    "union_tables_by_name": f"""WITH {_TICKS}
        SELECT ticker, price, volume, CASE WHEN ticker <> 'view' THEN ts END AS ts,
               CASE WHEN ticker = 'view' THEN seconds END AS timestamp FROM ticks""",
    "legacy_table": f"WITH {_SENT} SELECT ticker, price, volume, ts, {_PARTS} FROM sent",
    # quality and models
    "not_null_violations": """SELECT documents.doc_id, quality FROM documents
        LEFT JOIN labels ON documents.doc_id = labels.doc_id WHERE quality IS NULL""",
    "unique_violations": """SELECT o_custkey, count(*) AS n_records FROM orders
        WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""",
    "check_ticks": """SELECT 'ticker_column' AS "check", true AS passed
        UNION ALL SELECT 'event_time_column', true
        UNION ALL SELECT 'has_rows', count(*) > 0 FROM events
        UNION ALL SELECT 'has_tickers', count(event_type) > 0 FROM events""",
    "model_reference": "SELECT user_id AS id, event_id FROM events WHERE user_id = 1",
    "model_table": "SELECT o_custkey AS id, o_orderkey FROM orders WHERE o_custkey = 1",
    # inventories
    "inventory_summary": f"""WITH {_FILES}
        SELECT count(*) AS total_files, CAST(sum(size) AS BIGINT) AS total_bytes FROM files""",
    "inventory_by_group": f"""WITH {_FILES}
        SELECT coalesce(nullif(regexp_extract(key, 'year=\\d{{4}}'), ''), 'ungrouped') AS label,
               count(*) AS n_files, CAST(sum(size) AS BIGINT) AS n_bytes
        FROM files GROUP BY 1 ORDER BY 1""",
    "inventory_by_date_group": f"""WITH {_FILES}
        SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'ungrouped'
                    WHEN year(last_modified) BETWEEN 1990 AND 1995 THEN 'date=199'
                    ELSE 'year=' || year(last_modified) END AS label,
               count(*) AS n_files, CAST(sum(size) AS BIGINT) AS n_bytes
        FROM files GROUP BY 1 ORDER BY 1""",
    "inventory_by_partition": f"WITH {_FILES} SELECT label, count(*) AS n_files FROM labelled GROUP BY label",
    "largest_files": f"WITH {_FILES} SELECT key, size FROM files ORDER BY size DESC, key LIMIT 5",
    "inventory_diff": f"""WITH {_FILES},
        b AS (SELECT key, size FROM files WHERE o_orderstatus <> 'P'),
        a AS (SELECT key, size + CAST(o_orderstatus = 'F' AS INTEGER) AS size
              FROM files WHERE o_orderpriority <> '1-URGENT')
        SELECT coalesce(b.key, a.key) AS key,
               CASE WHEN b.key IS NULL THEN 'added' WHEN a.key IS NULL THEN 'removed'
                    ELSE 'size_changed' END AS change,
               b.size AS size_before, a.size AS size_after
        FROM b FULL OUTER JOIN a ON b.key = a.key
        WHERE b.key IS NULL OR a.key IS NULL OR b.size <> a.size""",
    "file_history": f"""WITH {_FILES}, s AS (
          SELECT 1 AS n, key, size FROM files WHERE o_orderstatus <> 'P'
          UNION ALL SELECT 2, key, size + CAST(o_orderstatus = 'F' AS INTEGER) FROM files WHERE o_orderpriority <> '1-URGENT'
          UNION ALL SELECT 3, key, size FROM files WHERE o_orderstatus = 'O'
          UNION ALL SELECT 4, key, size FROM files WHERE o_orderstatus <> 'P'),
        g AS (SELECT key, size, n, n - row_number() OVER (PARTITION BY key, size ORDER BY n) AS stay FROM s)
        SELECT key, size, TIMESTAMP '2023-12-31' + to_days(CAST(min(n) AS INTEGER)) AS valid_from,
               CASE WHEN max(n) < 4 THEN TIMESTAMP '2024-01-01' + to_days(CAST(max(n) AS INTEGER)) END AS valid_to
        FROM g GROUP BY key, size, stay""",
    "inventory_as_of": f"""WITH {_FILES}
        SELECT key, size + CAST(o_orderstatus = 'F' AS INTEGER) AS size FROM files WHERE o_orderpriority <> '1-URGENT'""",
    "inventory_changes_between": f"""WITH {_FILES},
        b AS (SELECT key, size + CAST(o_orderstatus = 'F' AS INTEGER) AS size FROM files WHERE o_orderpriority <> '1-URGENT'),
        a AS (SELECT key, size FROM files WHERE o_orderstatus <> 'P')
        SELECT coalesce(b.key, a.key) AS key,
               CASE WHEN b.key IS NULL THEN 'added' WHEN a.key IS NULL THEN 'removed' ELSE 'size_changed' END AS change,
               b.size AS size_before, a.size AS size_after
        FROM b FULL JOIN a ON a.key = b.key WHERE b.key IS NULL OR a.key IS NULL OR a.size <> b.size""",
    "inventory_snapshot": f"""WITH {_FILES}
        SELECT key, size, last_modified, 'tick-lake' AS base FROM files""",
    "compaction_reduction": f"""WITH {_FILES}, n AS (
        SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS files_before,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS files_after FROM files)
        SELECT 'all' AS label, files_before, files_after,
               round(CAST(files_before - files_after AS DOUBLE) / files_before * 100, 6) AS reduction_pct
        FROM n""",
    "compaction_reduction_by_day": f"WITH {_REDUCTION} SELECT * FROM r",
    "compaction_check_by_day": f"WITH {_REDUCTION} SELECT * FROM r WHERE reduction_pct < 50",
    "compaction_check_strict": f"""WITH {_REDUCTION}
        SELECT * FROM r WHERE reduction_pct < 0 OR files_after >= files_before""",
    "compaction_check_overall": f"""WITH {_FILES}, n AS (
        SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS files_before,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS files_after FROM files),
        r AS (SELECT 'all' AS label, files_before, files_after,
                     round(CAST(files_before - files_after AS DOUBLE) / files_before * 100, 6) AS reduction_pct
              FROM n)
        SELECT * FROM r WHERE reduction_pct < 75""",
    "compaction_check_overall_strict": f"""WITH {_FILES}, n AS (
        SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS files_before,
               count(*) FILTER (WHERE o_orderstatus <> 'P') AS files_after FROM files)
        SELECT 'all' AS label, files_before, files_after,
               round(CAST(files_before - files_after AS DOUBLE) / files_before * 100, 6) AS reduction_pct
        FROM n WHERE files_after >= files_before""",
    # lakes
    "lake_scan": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "lake_partitions": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks
        WHERE year = 2024 AND month = 1 AND (day = 5 OR (day = 7 AND hour = 9))""",
    "run_day_ticks": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks WHERE CAST(ts AS DATE) = DATE '2024-01-09'""",
    "lake_since": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks WHERE ts >= TIMESTAMP '2024-01-20 12:30:00'""",
    "lake_inventory": f"""WITH {_HOURS}
        SELECT 'year=' || year || '/month=' || month || '/day=' || day AS label,
               CAST(sum(n_files) AS BIGINT) AS n_files FROM hours GROUP BY 1""",
    "newest_file": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks
        WHERE date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM ticks)""",
    "last_files_by_name": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks
        QUALIFY dense_rank() OVER (ORDER BY year DESC, month DESC, day DESC, hour DESC) <= 10""",
    "compaction_report": f"""WITH {_HOURS}
        SELECT 'year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour AS partition,
               'compacted' AS status, n_rows AS rows_before, n_rows AS rows_after,
               n_files AS files_before, CAST(1 AS BIGINT) AS files_after FROM hours
        UNION ALL SELECT 'year=2024/month=13', 'missing', NULL, NULL, NULL, NULL""",
    "compaction_many_files": f"""WITH {_HOURS}
        SELECT 'year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour AS partition,
               'compacted' AS status, n_rows AS rows_before, n_rows AS rows_after,
               CAST(3 AS BIGINT) AS files_wanted, true AS within FROM hours""",
    "compaction_hot_hour": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "compacted_rows": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "verified_compaction": f"""WITH {_HOURS}, d AS (
        SELECT 'year=' || year || '/month=' || month || '/day=' || day AS label,
               CAST(sum(n_files) AS BIGINT) AS files_before, count(*) AS files_after
        FROM hours GROUP BY 1)
        SELECT label, files_before, files_after,
               round(CAST(files_before - files_after AS DOUBLE) / files_before * 100, 6) AS reduction_pct
        FROM d""",
    "repeated_compaction": f"""WITH {_TICKS}
        SELECT {_COLUMNS} FROM ticks""",
    "ticks_view": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "ticks_view_late": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "stale_hours": f"""WITH {_HOURS}, d AS (
        SELECT year, month, day, row_number() OVER (ORDER BY year, month, day) AS n, count(*) OVER () AS days
        FROM (SELECT DISTINCT year, month, day FROM hours))
        SELECT year, month, day, hour, n_rows AS raw_rows, CAST(0 AS BIGINT) AS compacted_rows
        FROM hours JOIN d USING (year, month, day) WHERE n > (days + 1) // 2""",
    # streams
    "ticks_after_dead_batch": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks",
    "tick_stream_roundtrip": f"WITH {_SENT} SELECT ticker, price, volume, ts, {_PARTS} FROM sent",
    "message_file_stream": f"WITH {_SENT} SELECT ticker, price, volume, ts, {_PARTS} FROM sent",
    "restarted_tick_stream": f"""WITH {_SENT}
        SELECT {_PARTS}, count(*) AS total_records FROM sent GROUP BY 1, 2, 3, 4""",
    "quarantine_stream": f"""WITH {_DRIFT}
        SELECT coalesce(reason, 'good') AS outcome, count(*) AS n_messages FROM drift GROUP BY 1""",
    "unpartitioned_stream": f"WITH {_SENT} SELECT ticker, price, volume, seconds AS timestamp FROM sent",
    "windowed_ticker_stats": f"""WITH {_TICKS}
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_WINDOW}
        FROM ticks GROUP BY 1, 2, ticker""",
    "sliding_ticker_stats": f"""WITH {_TICKS}, placed AS (
        SELECT ticker, price,
               time_bucket(INTERVAL 30 MINUTE, ts) - s.back * INTERVAL 30 MINUTE AS window_start
        FROM ticks, (VALUES (0), (1)) AS s(back))
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, {_WINDOW}
        FROM placed GROUP BY 1, 2, ticker""",
    "windowed_stats_stream": f"""WITH {_TICKS}, w AS (
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_WINDOW}
        FROM ticks GROUP BY 1, 2, ticker)
        SELECT * FROM w WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ticks)""",
    "windowed_stats_complete_stream": f"""WITH {_TICKS}
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_WINDOW}
        FROM ticks GROUP BY 1, 2, ticker""",
    "windowed_stats_update_stream": f"""WITH {_TICKS}
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_WINDOW}
        FROM ticks GROUP BY 1, 2, ticker""",
    "latest_ticks_stream": f"WITH {_TICKS} SELECT {_COLUMNS} FROM ticks ORDER BY {_NEWEST} LIMIT 5",
    "saved_summary": f"""WITH {_TICKS}
        SELECT ticker, count(*) AS total_records, round(avg(price), 6) AS avg_price,
               min(price) AS min_price, max(price) AS max_price FROM ticks GROUP BY ticker""",
}

ORACLES |= {
    f"{name}_rollup": ORACLES[name]
    for name in ("ticker_summary", "ticker_kpis", "avg_price_by_hour_ticker", "record_count_by_ticker")
}
ORACLES["ticker_summary_rollup_late"] = ORACLES["ticker_summary"]

_RARE = f"""WITH users AS (
    SELECT 'user-' || user_id AS ticker, value AS price, CAST(json_extract_string(props, '$.k') AS INTEGER) AS volume,
           ts, {_PARTS} FROM events),
  rarest AS (SELECT ticker FROM users WHERE ticker IS NOT NULL GROUP BY ticker ORDER BY count(*), ticker LIMIT 3)
  SELECT {_COLUMNS} FROM users WHERE ticker IN (SELECT ticker FROM rarest)"""

ORACLES |= {
    "rare_ticker_ticks": _RARE,
    "rare_ticker_ticks_since": f"{_RARE} AND ts >= TIMESTAMP '2024-01-08 06:15:00'",
}

ORACLES |= {
    # Two runs of two files, so each message counts twice.
    "observed_ingest": f"""WITH {_DRIFT}
        SELECT CAST(4 AS BIGINT) AS n_batches, 2 * count(*) AS n_messages, 2 * count(reason) AS n_bad,
               min(ts) FILTER (reason IS NULL) AS oldest_ts, max(ts) FILTER (reason IS NULL) AS newest_ts,
               CAST(4 AS BIGINT) AS n_timed
        FROM drift""",
    "repeated_messages_stream": f"""WITH {_SENT}
        SELECT DISTINCT ticker, price, volume, ts, {_PARTS} FROM sent""",
}
