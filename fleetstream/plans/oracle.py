"""DuckDB SQL equivalents of the registered queries, written from the numbers.

Text that the queries parse is not parsed here: the expected values come from the table
columns the text was rendered from.
"""

from __future__ import annotations

T0 = 1_704_067_200_000
HOUR = 3_600_000
TICK = 6 * HOUR

TEL = f"""
WITH src AS (
  SELECT event_id, event_id AS seq, user_id, epoch_us(ts) // 1000 AS arrival_ms,
         CAST(value AS FLOAT) AS engine,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
tel AS (
  SELECT seq, arrival_ms, user_id, engine,
         concat(user_id % 20, '-', user_id // 20) AS device_id,
         CAST(user_id % 20 AS INTEGER) AS pilot_index, CAST(user_id // 20 AS INTEGER) AS replica,
         CAST(event_id * 0.25 AS FLOAT) AS session_time,
         CAST(event_id % 1000000 AS INTEGER) AS frame,
         CAST(event_id % 300 AS FLOAT) AS speed,
         CAST(greatest(k + 3, (event_id * 31) % 120) AS DOUBLE) AS tyre,
         arrival_ms - (event_id * 7919 % 5) * 600000 AS t_emit,
         (arrival_ms - (event_id * 7919 % 5) * 600000) // {HOUR} AS key
  FROM src)
"""

WINDOW = f"""
  key * {HOUR} AS window_start, key * {HOUR} + {HOUR} AS window_end, count(*) AS count,
  round(avg(CAST(engine AS DOUBLE)), 4) AS mean_engine_temp,
  round(avg(tyre), 4) AS mean_tyre_temp,
  CAST(trunc(greatest(max(CAST(engine AS DOUBLE)), 0)) AS BIGINT) AS max_engine_temp,
  CAST(trunc(greatest(max(tyre), 0)) AS BIGINT) AS max_tyre_temp,
  min(t_emit) AS earliest_t_emit, max(t_emit) AS latest_t_emit
"""

WINDOW_NAMES = (
    "window_start, window_end, count, mean_engine_temp, mean_tyre_temp, max_engine_temp, "
    "max_tyre_temp, earliest_t_emit, latest_t_emit"
)

LATE = (
    TEL
    + """,
lat AS (
  SELECT *, coalesce(key < max(key) OVER (
    ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late
  FROM tel)
"""
)

EXACT = (
    LATE
    + f""",
acc AS (SELECT * FROM lat WHERE NOT late),
closing AS (
  SELECT key, lead(arr) OVER (ORDER BY key) AS closed_at_ms
  FROM (SELECT key, arg_min(arrival_ms, seq) AS arr FROM acc GROUP BY key)),
exact AS (
  SELECT w.*, closed_at_ms, closed_at_ms - earliest_t_emit AS e2e_latency_ms
  FROM (SELECT key, avg(CAST(engine AS DOUBLE)) AS raw_engine, avg(tyre) AS raw_tyre, {WINDOW}
        FROM acc GROUP BY key) w
  JOIN closing USING (key) WHERE closed_at_ms IS NOT NULL)
"""
)

GOOD = "seq % 6 IN (0, 1, 2)"

BATCHES = (
    TEL
    + f""",
ranked AS (
  SELECT *, (arrival_ms - {T0}) // {TICK} AS tick,
         (row_number() OVER (PARTITION BY (arrival_ms - {T0}) // {TICK} ORDER BY seq) - 1) // 20
           AS batch_in_tick
  FROM tel),
grouped AS (
  SELECT tick, batch_in_tick, count(*) AS size, min(arrival_ms) AS first_arrival_ms,
         max(arrival_ms) AS last_arrival_ms, arg_max(t_emit, seq) AS last_t_emit
  FROM ranked GROUP BY ALL),
batch AS (
  SELECT row_number() OVER (ORDER BY tick, batch_in_tick) - 1 AS batch_seq, tick, batch_in_tick,
         size, first_arrival_ms, last_arrival_ms,
         CASE WHEN size >= 20 THEN last_arrival_ms ELSE {T0} + (tick + 1) * {TICK} END AS flush_ms,
         CASE WHEN size >= 20 THEN last_arrival_ms ELSE {T0} + (tick + 1) * {TICK} END
           - last_t_emit AS lag_ms
  FROM grouped)
"""
)


# The same tables for messages: those that decode, strictly or not.
TEL_GOOD = TEL.replace("FROM src)", f"FROM src WHERE {GOOD})")
TEL_STRICT = TEL.replace("FROM src)", "FROM src WHERE seq % 7 IN (0, 1, 6))").replace(
    "user_id, engine,", "user_id, CASE WHEN seq % 7 = 1 THEN 0 ELSE engine END AS engine,"
)
BATCHES_GOOD = BATCHES.replace(TEL, TEL_GOOD)
EXACT_STRICT = EXACT.replace(TEL, TEL_STRICT)


def p95(values: str) -> str:
    n = f"len({values})"
    return (
        f"list_sort({values})[CAST(least(floor({n} * CAST(0.95 AS DOUBLE)), {n} - 1) AS BIGINT) + 1]"
    )


REPLAY = (
    TEL
    + """,
clocked AS (
  SELECT *, CASE WHEN pilot_index <> 3 THEN device_id END AS session,
         CAST(seq * 0.25 + (seq % 17) * 0.5 + 1 AS FLOAT) AS clock FROM tel),
timed AS (
  SELECT *, CAST(trunc(CAST(clock * CAST(1000 AS FLOAT) AS DOUBLE) / CAST(100 AS DOUBLE)) AS BIGINT)
           AS session_ms FROM clocked),
waits AS (
  SELECT *, least(greatest(session_ms - lag(session_ms, 1, 0) OVER (
           PARTITION BY session ORDER BY seq), 0), 1000) AS wait_ms FROM timed),
line AS (
  SELECT *, CAST(sum(wait_ms) OVER (PARTITION BY session ORDER BY seq) AS BIGINT) AS offset_ms
  FROM waits)
"""
)


def fleet(size: str) -> str:
    """Devices of fleets listed in ``sizes(id, n)``, numbered pilot by pilot."""
    return f"""
pilots AS (SELECT unnest(range(20)) AS p),
members AS (
  SELECT id, p, unnest(range(CASE WHEN n < 20 THEN CAST(p < n AS INTEGER)
                             ELSE n // 20 + CAST(p < n % 20 AS INTEGER) END)) AS r
  FROM {size}, pilots),
devices AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY p, r) - 1 AS device_number,
         CAST(p AS INTEGER) AS pilot_index, CAST(r AS INTEGER) AS replica,
         concat(p, '-', r) AS device_id
  FROM members)
"""


RUNS = """
WITH base AS (
  SELECT o_orderkey AS k, o_custkey AS c, substr('ABCD', CAST(o_orderkey % 4 + 1 AS INTEGER), 1) AS scenario,
         CASE WHEN o_custkey % 2 = 1 THEN 'kafka' ELSE 'mqtt' END AS broker,
         (o_orderkey // 4) % 3 AS number, strftime(o_orderdate, '%Y%m%d') AS day,
         CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey * 37) % 3000 END AS emitted
  FROM orders),
counted AS (
  SELECT *,
         CASE WHEN broker = 'kafka' THEN (['acks0', 'acks1', 'acksall'])[number + 1]
              ELSE concat('qos', number) END AS raw_level,
         CASE WHEN k % 13 = 0 THEN coalesce(emitted, 0) + 5
              ELSE greatest(coalesce(emitted, 0) - c % 40, 0) END AS received
  FROM base),
runs AS (
  SELECT *, greatest(received - k % 7, 0) AS persisted, received // 50 AS batches,
         k % 2 = 0 AS has_dump,
         CASE WHEN scenario = 'A' THEN concat('scenario-A-', broker, '-', 100 + k, '-', raw_level)
              ELSE concat('scenario-', scenario, '-', broker, '-', day, '-',
                          lpad(CAST(k % 1000000 AS VARCHAR), 6, '0')) END AS run_id
  FROM counted)
"""

FACTS = (
    RUNS
    + """,
parsed AS (
  SELECT *,
    CASE WHEN scenario = 'A' THEN CAST(100 + k AS VARCHAR) ELSE '' END AS num_devices,
    CASE WHEN scenario = 'A' THEN raw_level ELSE '' END AS level,
    c % 4 AS alerts,
    CASE WHEN c % 4 > 0 THEN (4000 + (k + (c % 4) * 17) % 5000) / 100.0 END AS last_mean,
    CASE WHEN scenario = 'B' AND k % 5 <> 0 THEN c % 75 END AS recovery_s,
    scenario = 'B' AND k % 5 = 0 AS recovery_timeout,
    CASE WHEN scenario = 'D' THEN CASE WHEN c % 3 <> 0 THEN c % 250 - 5 ELSE c % 40 END END
      AS e2e_latency_s,
    CASE WHEN has_dump THEN k % 4 WHEN emitted IS NOT NULL AND k % 5 <> 1 THEN k % 3 END AS dropped,
    CASE WHEN has_dump THEN CAST(c % 30 AS DOUBLE) END AS storage_lag_ms,
    CASE WHEN has_dump THEN c % 30 + CAST(5.5 AS DOUBLE) END AS storage_p95_lag_ms,
    CASE WHEN k % 3 = 0 THEN CAST(coalesce(emitted, 0) AS DOUBLE) END AS ingest_emitted,
    CASE WHEN k % 3 = 0 THEN CAST(0 AS DOUBLE) END AS ingest_throughput,
    CASE WHEN has_dump THEN CAST(received AS DOUBLE) END AS storage_emitted,
    CASE WHEN has_dump THEN CAST(0 AS DOUBLE) END AS storage_throughput,
    CASE WHEN k % 3 = 1 THEN CAST(0 AS DOUBLE) END AS analytics_emitted,
    CASE WHEN k % 3 = 1 THEN CAST(0 AS DOUBLE) END AS analytics_throughput,
    CASE WHEN has_dump THEN received - persisted
         + CASE WHEN scenario = 'C' AND k % 3 <> 0 THEN c % 97 ELSE 0 END END AS peak_backlog,
    CAST(2 * (c % 90) + 3 AS DOUBLE) AS total_cpu_avg,
    CAST(2 * (k % 512) + 2 AS DOUBLE) AS total_mem_mb_avg,
    CASE WHEN emitted <> 0 THEN CASE scenario WHEN 'A' THEN 30 WHEN 'B' THEN 120 ELSE 180 END END
      AS duration_s
  FROM runs),
derived AS (
  SELECT *,
    CASE WHEN emitted <> 0 THEN CAST(printf('%.1f', CAST(emitted AS DOUBLE) / duration_s) AS DOUBLE) END
      AS throughput_msg_per_sec,
    CASE WHEN emitted <> 0 THEN CAST(printf('%.2f', CAST(100.0 AS DOUBLE) * (emitted - persisted) / emitted) AS DOUBLE) END
      AS loss_pct
  FROM parsed),
facts AS (
  SELECT *, coalesce(CASE
    WHEN e2e_latency_s < 0 THEN concat('e2e_latency_s=', e2e_latency_s, ' (negative)')
    WHEN duration_s IS NOT NULL AND e2e_latency_s > duration_s
      THEN concat('e2e_latency_s=', e2e_latency_s, ' > duration_s=', duration_s)
    WHEN recovery_timeout THEN 'recovery_s=timeout'
    WHEN recovery_s > 60 THEN concat('recovery_s=', recovery_s, ' > 60')
    WHEN emitted > 0 AND emitted < 100 THEN concat('emitted=', emitted, ' < 100')
    WHEN emitted > 0 AND received > emitted THEN concat('received=', received, ' > emitted=', emitted)
    WHEN received = 0 AND coalesce(emitted, 0) NOT BETWEEN 1 AND 99
      AND (coalesce(emitted, 0) = 0 OR batches = 0) THEN 'received=0'
    WHEN alerts = 0 AND scenario = 'D' THEN 'alerts=0' END, '') AS _invalid_reason
  FROM derived),
latest AS (
  SELECT *, _invalid_reason = '' AS _valid FROM facts
  QUALIFY row_number() OVER (
    PARTITION BY scenario, broker ORDER BY (_invalid_reason = '') DESC, run_id DESC) = 1)
"""
)

REPEATED = (
    TEL
    + """,
rep AS (
  SELECT *, unnest(range(CASE WHEN seq % 49 = 0 THEN 3 WHEN seq % 7 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM tel)
"""
)

PERSISTED = f"""
  device_id, pilot_index, replica, round(CAST(session_time AS DOUBLE), 2) AS sessionTime,
  frame AS frameIdentifier, round(CAST(speed AS DOUBLE), 2) AS speed, t_emit AS t_emit_ms,
  CAST({T0} AS BIGINT) AS t_persist_ms, device_id AS payload_device, t_emit AS payload_t_emit
"""

HISTOGRAM_BOUNDS = [60 * b for b in (40.0, 45.0, 50.0, 55.0, 60.0, 62.0, 65.0, 70.0, 80.0)]
BOUND_ROWS = ", ".join([*(f"('{b}', {b})" for b in HISTOGRAM_BOUNDS), "('+Inf', 1e300)"])

ALERT_TEXT = (
    "ALERT window_start=%d window_end=%d count=%d mean_engine_temp=%.2f mean_tyre_temp=%.2f "
    "max_engine_temp=%d max_tyre_temp=%d e2e_latency_ms=%d"
)

ORACLES: dict[str, str] = {
    "window_alerts": f"""{TEL} SELECT {WINDOW} FROM tel
        WHERE key < (SELECT max(key) FROM tel) GROUP BY key
        HAVING avg(CAST(engine AS DOUBLE)) > 50""",
    "window_late_filter": f"""{LATE} SELECT device_id, count(*) FILTER (NOT late) AS accepted,
        count(*) FILTER (late) AS late FROM lat GROUP BY device_id""",
    "window_late_counts": f"""{LATE} SELECT count(*) FILTER (NOT late) AS accepted,
        count(*) FILTER (late) AS late FROM lat""",
    "window_exact_alerts": f"{EXACT} SELECT {WINDOW_NAMES} FROM exact WHERE raw_engine > 50",
    "window_latest_mean": f"{EXACT} SELECT arg_max(mean_engine_temp, key) AS mean_engine_temp FROM exact",
    "window_flush_all": f"{TEL} SELECT {WINDOW} FROM tel GROUP BY key ORDER BY key",
    "window_close_latency": f"""{EXACT} SELECT window_start, closed_at_ms, earliest_t_emit,
        e2e_latency_ms FROM exact""",
    "latency_histogram": f"""{EXACT}, bounds(le, b) AS (VALUES {BOUND_ROWS})
        SELECT le, count(*) FILTER (e2e_latency_ms / CAST(1000 AS DOUBLE) <= b) AS observations,
               round(sum(e2e_latency_ms) / CAST(1000 AS DOUBLE), 2) AS sum_s, count(*) AS count
        FROM exact, bounds GROUP BY le""",
    "alert_lines": f"""{EXACT} SELECT window_start, printf('{ALERT_TEXT}', window_start, window_end,
        count, raw_engine, raw_tyre, max_engine_temp, max_tyre_temp, e2e_latency_ms) AS line
        FROM exact WHERE raw_engine > 50""",
    "alert_line_fields": f"""{EXACT} SELECT window_start, window_end, count, max_engine_temp,
        max_tyre_temp, e2e_latency_ms FROM exact WHERE raw_engine > 50""",
    "csv_by_name": f"""{TEL} SELECT round(CAST(session_time AS DOUBLE), 2) AS sessionTime,
        frame AS frameIdentifier, pilot_index, round(user_id * CAST(0.5 AS DOUBLE), 2) AS worldPositionX,
        CAST(-user_id AS DOUBLE) AS worldPositionY, CAST(seq % 1000 AS DOUBLE) AS worldPositionZ,
        CAST(speed AS DOUBLE) AS speed, round(CAST(engine AS DOUBLE), 3) AS engineTemperature,
        tyre AS tyresSurfaceTemperature FROM tel""",
    "csv_rejects": f"""{TEL} SELECT CASE seq % 10 WHEN 0 THEN 'frameIdentifier'
        WHEN 7 THEN 'tyresSurfaceTemperature' WHEN 3 THEN 'none, NaN speed' ELSE 'none' END AS bad_column,
        count(*) AS rows, CAST(sum(pilot_index) AS BIGINT) AS pilots FROM tel GROUP BY ALL""",
    "multi_value_cells": f"""{TEL} SELECT seq, CAST(CASE seq % 5 WHEN 0 THEN tyre WHEN 1 THEN seq % 97
        WHEN 4 THEN NULL ELSE 0 END AS DOUBLE) AS value FROM tel""",
    "decode_accept": f"""{TEL} SELECT seq, device_id, pilot_index, replica,
        round(CAST(engine AS DOUBLE), 3) AS engineTemperature, tyre AS tyresSurfaceTemperature, t_emit
        FROM tel WHERE {GOOD}""",
    "decode_reject": f"""{TEL} SELECT seq, CASE WHEN seq % 6 = 5 THEN 'invalid json'
        ELSE 'missing required fields' END AS reject_reason, CAST(200 AS INTEGER) AS excerpt_length
        FROM tel WHERE NOT {GOOD}""",
    "decode_strict": f"""{TEL} SELECT seq, t_emit, CASE WHEN seq % 7 = 1 THEN 0
        ELSE round(CAST(engine AS DOUBLE), 3) END AS engineTemperature,
        tyre AS tyresSurfaceTemperature FROM tel WHERE seq % 7 IN (0, 1, 6)""",
    "topic_filter": f"""{TEL} SELECT CASE WHEN device_id LIKE '%0' THEN 'xiot/telemetry/' || device_id
        ELSE 'iot/telemetry/' || device_id END AS topic, count(*) AS messages,
        device_id NOT LIKE '%0' AS all_devices, true AS one_level FROM tel GROUP BY device_id""",
    "keyed_messages": f"""{TEL} SELECT device_id AS key, 'iot-telemetry' AS topic, device_id, t_emit,
        round(CAST(engine AS DOUBLE), 3) AS engine, CAST(12 AS INTEGER) AS fields FROM tel""",
    "mask_url": """SELECT page_id, regexp_replace(replace(url, '://', concat('://iot:pw', page_id, '@')),
        ':[^:@]+@', ':***@') AS url FROM pages""",
    "persist_rows": f"{TEL} SELECT {PERSISTED} FROM tel WHERE {GOOD}",
    "event_batches": f"{BATCHES} SELECT seq, tick, batch_in_tick FROM ranked",
    "flush_batches": f"{BATCHES} SELECT * FROM batch",
    "flush_batches_messages": f"{BATCHES_GOOD} SELECT * FROM batch",
    "batch_p95": f"{BATCHES} SELECT {p95('list(lag_ms)')} AS p95_lag_ms FROM batch",
    "rolling_p95": f"""{BATCHES}, hist AS (SELECT batch_seq, lag_ms, list(lag_ms) OVER (
        ORDER BY batch_seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS h FROM batch)
        SELECT batch_seq, lag_ms, {p95('h')} AS p95_lag_ms FROM hist""",
    "row_lag": f"""{TEL}, lags AS (
        SELECT CASE WHEN seq % 11 <> 0 THEN pilot_index END AS pilot_index, arrival_ms + seq % 7 - t_emit AS lag FROM tel)
        SELECT pilot_index, count(*) AS rows, round(avg(lag), 4) AS mean_lag_ms,
        max(lag) AS max_lag_ms, {p95('list(lag)')} AS p95_lag_ms FROM lags GROUP BY pilot_index""",
    "device_fanout": f"""WITH sizes AS (SELECT c_nationkey AS id, count(*) AS n FROM customer
        GROUP BY c_nationkey), {fleet('sizes')}
        SELECT id AS c_nationkey, device_number, pilot_index, replica, device_id FROM devices""",
    "cyclic_expand": f"""{TEL}, sizes AS (SELECT 0 AS id, 45 AS n), {fleet('sizes')},
        numbered AS (SELECT row_number() OVER (ORDER BY seq) - 1 AS row_index, frame FROM tel),
        amount AS (SELECT count(*) AS r, CAST(trunc(300 * (CAST((5 * count(*) * 1000) // 600 AS DOUBLE)
          / 1000)) AS BIGINT) AS total FROM tel),
        emissions AS (SELECT unnest(range(total)) AS emission, r FROM amount)
        SELECT d.device_id, count(*) AS events, CAST(sum(emission) AS BIGINT) AS emission_sum,
          CAST(sum(frame) AS BIGINT) AS frame_sum, min({T0} + emission * 3333 // 1000) AS first_t_emit,
          max({T0} + emission * 3333 // 1000) AS last_t_emit
        FROM emissions JOIN numbered ON row_index = emission % r
        JOIN devices d ON device_number = emission % 45 GROUP BY d.device_id""",
    "replay_timeline": f"{REPLAY} SELECT seq, session, session_ms, wait_ms, offset_ms FROM line",
    "device_replay": f"""{REPLAY}, sizes AS (SELECT 0 AS id, 25 AS n), {fleet('sizes')},
        starts AS (SELECT session, arg_min(session_ms, seq) AS start_ms FROM line
          WHERE session_ms >= 0 GROUP BY session),
        ends AS (SELECT line.session, min(seq) AS last FROM line JOIN starts ON line.session IS NOT DISTINCT FROM starts.session
          WHERE start_ms > 0 AND session_ms - start_ms >= 15000 GROUP BY line.session),
        kept AS (SELECT l.* FROM line l LEFT JOIN ends e ON l.session IS NOT DISTINCT FROM e.session
          WHERE e.last IS NULL OR l.seq <= e.last),
        total AS (SELECT session, max(offset_ms) AS length FROM kept GROUP BY session)
        SELECT kept.session, d.device_id, count(*) AS events, CAST(sum(seq) AS BIGINT) AS seq_sum,
          max(device_number * length + offset_ms) AS last_elapsed_ms,
          max({T0} + device_number * length + offset_ms) AS last_t_emit
        FROM kept JOIN total ON kept.session IS NOT DISTINCT FROM total.session, devices d
        GROUP BY kept.session, d.device_id""",
    "critical_overlay": f"""{TEL}, pick AS (SELECT * FROM tel WHERE arrival_ms - {T0} >= {240 * HOUR}
          ORDER BY seq LIMIT 1),
        overlay AS (SELECT engine, tyre, t_emit FROM tel UNION ALL
          SELECT CAST(1500 AS FLOAT), tyre, arrival_ms + i FROM pick, (SELECT unnest(range(100)) AS i)),
        k AS (SELECT *, t_emit // {HOUR} AS key FROM overlay)
        SELECT {WINDOW} FROM k WHERE key < (SELECT max(key) FROM k) GROUP BY key""",
    "metric_dump_parse": f"""{RUNS}, dumped AS (
        SELECT run_id, 'storage_metrics.txt' AS file_name, unnest(['storage_received_total',
          'storage_persisted_total', 'storage_dropped_total', 'storage_batches_total',
          'storage_lag_ms', 'storage_p95_lag_ms']) AS metric,
          unnest([CAST(received AS DOUBLE), persisted, k % 4, batches, c % 30, c % 30 + 5.5]) AS amount
        FROM runs WHERE k % 2 = 0
        UNION ALL SELECT run_id, 'ingest_metrics.txt', unnest(['ingest_emitted_total',
          'ingest_latency_bucket{{le="0.05"}}']), unnest([CAST(coalesce(emitted, 0) AS DOUBLE), c])
        FROM runs WHERE k % 3 = 0
        UNION ALL SELECT run_id, 'analytics_metrics.txt', 'analytics_messages_total',
          CAST(received AS DOUBLE) FROM runs WHERE k % 3 = 1)
        SELECT run_id, file_name, metric, amount FROM dumped""",
    "ingest_log_parse": f"""{FACTS} SELECT run_id, emitted,
        CASE WHEN emitted IS NOT NULL AND k % 5 <> 1 THEN k % 3 END AS dropped FROM facts
        WHERE emitted IS NOT NULL OR (scenario = 'D' AND k % 5 <> 0)""",
    "analytics_log_parse": f"""{FACTS} SELECT run_id, alerts, CAST(last_mean AS DOUBLE) AS last_mean
        FROM facts WHERE c % 4 > 0""",
    "timing_log_parse": f"""{FACTS} SELECT run_id, recovery_s, recovery_timeout, e2e_latency_s
        FROM facts WHERE scenario IN ('B', 'D')""",
    "storage_log_parse": f"""{FACTS} SELECT run_id, batches, received, persisted FROM facts
        WHERE NOT has_dump""",
    "last_alert_lines": f"""{RUNS}, alerts AS (SELECT run_id, c, unnest(range(1, c % 4 + 1)) AS line_no
        FROM runs) SELECT run_id, line_no FROM alerts WHERE line_no > c % 4 - 2""",
    "container_usage": """WITH used AS (
        SELECT concat('scenario-C-kafka-20260101-', lpad(CAST(l_orderkey % 500 AS VARCHAR), 6, '0')) AS run_id,
          l_suppkey % 5 AS name,
          CASE WHEN l_linenumber % 7 = 0 THEN CAST(0 AS DOUBLE)
               ELSE CAST(round(l_discount * 100) AS INTEGER) + CAST(0.503712 AS DOUBLE) END AS cpu,
          (CAST(l_quantity AS INTEGER) + CAST(0.503712 AS DOUBLE)) * CAST(([1024, 1, 0.001, 0.000001])[l_linenumber % 4 + 1] AS DOUBLE) AS mem
        FROM lineitem WHERE l_suppkey % 5 <> 3),
        means AS (SELECT run_id, name, avg(cpu) AS cpu, avg(mem) AS mem FROM used GROUP BY ALL)
        SELECT run_id, CAST(printf('%.2f', sum(cpu)) AS DOUBLE) AS total_cpu_avg,
          CAST(printf('%.2f', sum(mem)) AS DOUBLE) AS total_mem_mb_avg
        FROM means GROUP BY run_id""",
    "peak_backlog": f"{FACTS} SELECT run_id, peak_backlog FROM facts WHERE has_dump",
    "run_facts": f"""{FACTS} SELECT alerts, analytics_emitted, analytics_throughput, batches, broker,
        dropped, CAST(duration_s AS BIGINT) AS duration_s, e2e_latency_s, emitted, ingest_emitted,
        ingest_throughput, CAST(last_mean AS DOUBLE) AS last_mean, level, loss_pct, num_devices,
        peak_backlog, persisted, received, recovery_s, recovery_timeout, run_id, scenario,
        storage_emitted, storage_lag_ms, storage_p95_lag_ms, storage_throughput,
        throughput_msg_per_sec, total_cpu_avg, total_mem_mb_avg FROM facts""",
    "run_validation": f"""{FACTS} SELECT run_id, _invalid_reason = '' AS _valid, _invalid_reason
        FROM facts""",
    "run_union": f"""{FACTS} SELECT emitted, CASE WHEN scenario = 'A' THEN loss_pct END AS loss_pct,
        CASE WHEN scenario <> 'A' THEN peak_backlog END AS peak_backlog, run_id, scenario,
        CASE WHEN scenario = 'A' THEN throughput_msg_per_sec END AS throughput_msg_per_sec FROM facts""",
    "latest_valid_run": f"""{FACTS} SELECT scenario, broker, run_id, _valid, emitted, persisted
        FROM latest""",
    "comparison_a": f"""{FACTS} SELECT broker, coalesce(num_devices, 'n/a') AS num_devices,
        coalesce(level, 'n/a') AS level,
        coalesce(CAST(CAST(throughput_msg_per_sec AS DECIMAL(38, 1)) AS VARCHAR), 'n/a') AS throughput,
        coalesce(CAST(loss_pct AS VARCHAR), 'n/a') AS loss_pct,
        CAST(total_cpu_avg AS VARCHAR) AS cpu_avg, CAST(total_mem_mb_avg AS VARCHAR) AS mem_mb_avg
        FROM latest WHERE scenario = 'A'""",
    "comparison_b": f"""{FACTS} SELECT broker, 'n/a' AS num_devices,
        coalesce(CAST(duration_s AS VARCHAR), 'n/a') AS duration_s,
        CASE WHEN recovery_timeout THEN 'timeout' ELSE coalesce(CAST(recovery_s AS VARCHAR), 'n/a') END
          AS recovery_s,
        coalesce(CAST(e2e_latency_s AS VARCHAR), 'n/a') AS e2e_s, 'n/a' AS alert_after_reconnect,
        CAST(total_cpu_avg AS VARCHAR) AS cpu_avg, CAST(total_mem_mb_avg AS VARCHAR) AS mem_mb_avg
        FROM latest WHERE scenario = 'B'""",
    "comparison_d": f"""{FACTS} SELECT broker, CAST(alerts AS VARCHAR) AS alerts,
        coalesce(CAST(CAST(last_mean AS DOUBLE) AS VARCHAR), 'n/a') AS last_mean,
        coalesce(CAST(e2e_latency_s AS VARCHAR), 'n/a') AS e2e_s,
        CAST(total_cpu_avg AS VARCHAR) AS cpu_avg, CAST(total_mem_mb_avg AS VARCHAR) AS mem_mb_avg
        FROM latest WHERE scenario = 'D'""",
    "facts_csv": f"""{FACTS} SELECT scenario, run_id, emitted, _invalid_reason = '' AS _valid, broker
        FROM facts""",
    "comparison_table": f"""{FACTS} SELECT broker, 'n/a' AS num_devices,
        coalesce(CAST(duration_s AS VARCHAR), 'n/a') AS duration_s,
        CAST(CAST(storage_lag_ms AS BIGINT) AS VARCHAR) AS lag_ms,
        CAST(storage_p95_lag_ms AS VARCHAR) AS p95_lag_ms, CAST(peak_backlog AS VARCHAR) AS peak_backlog,
        CAST(total_cpu_avg AS VARCHAR) AS cpu_avg, CAST(total_mem_mb_avg AS VARCHAR) AS mem_mb_avg
        FROM latest WHERE scenario = 'C'""",
    "normalise_level": f"""{RUNS}, asked AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'mqtt' ELSE broker END AS b
        FROM runs) SELECT k, CASE WHEN k % 10 = 0 THEN NULL
        WHEN number < 2 THEN CAST(number AS VARCHAR)
        WHEN broker = 'kafka' AND b = 'kafka' THEN 'all'
        WHEN broker = 'mqtt' THEN '2' END AS level FROM asked""",
    "duplicate_summary": f"""{REPEATED} SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct,
        CAST(sum(n - 1) AS BIGINT) AS duplicates
        FROM (SELECT count(*) AS n FROM rep GROUP BY device_id, frame, t_emit)""",
    "duplicate_keys": f"""{REPEATED} SELECT device_id, frame AS frameIdentifier, t_emit,
        count(*) AS copies FROM rep GROUP BY ALL HAVING count(*) > 1""",
    "first_duplicates": f"""{REPEATED} SELECT t_emit, count(*) AS copies FROM rep GROUP BY t_emit
        HAVING count(*) > 1 ORDER BY t_emit LIMIT 5""",
    "distinct_devices": f"{REPEATED} SELECT DISTINCT device_id FROM rep",
    "key_head_tail": f"""{REPEATED} SELECT t_emit, 'first' AS part FROM
        (SELECT t_emit FROM rep ORDER BY t_emit LIMIT 10)
        UNION ALL SELECT t_emit, 'last' FROM (SELECT t_emit FROM rep ORDER BY t_emit DESC LIMIT 5)""",
    "key_arrival_ends": f"""{REPEATED} SELECT t_emit, 'first' AS part FROM
        (SELECT t_emit FROM rep ORDER BY seq, copy LIMIT 10)
        UNION ALL SELECT t_emit, 'last' FROM (SELECT t_emit FROM rep ORDER BY seq DESC, copy DESC LIMIT 5)""",
    "delivery_reconcile": f"""{TEL}, seen AS (
          SELECT device_id, frame, t_emit FROM tel WHERE pilot_index <> 7
          UNION ALL SELECT device_id, frame, t_emit FROM tel WHERE pilot_index % 3 = 0
          UNION ALL SELECT device_id, frame, t_emit + 1 FROM tel WHERE pilot_index % 5 = 1),
        obs AS (SELECT device_id, count(*) AS observed_total, count(DISTINCT (frame, t_emit)) AS observed
          FROM seen GROUP BY device_id),
        staged AS (SELECT device_id AS run_id, count(*) AS expected,
          count(*) FILTER (seq % 50 <> 0) AS emitted, nullif(count(*) FILTER (seq % 50 = 0), 0) AS dropped,
          count(*) FILTER (seq % 20 <> 0) AS received,
          count(*) FILTER (seq % 10 <> 0) AS persisted,
          nullif(count(*) FILTER (seq % 10 <> 0 AND pilot_index <> 5), 0) AS analysed
        FROM tel GROUP BY device_id),
        counts AS (SELECT staged.*, observed_total, observed, observed_total - observed AS observed_duplicates
          FROM staged LEFT JOIN obs ON obs.device_id = staged.run_id)
        SELECT *, round(CAST(emitted AS DOUBLE) / expected, 4) AS emitted_ratio,
          round(CAST(received AS DOUBLE) / expected, 4) AS received_ratio,
          round(CAST(persisted AS DOUBLE) / expected, 4) AS persisted_ratio,
          round(CAST(analysed AS DOUBLE) / expected, 4) AS analysed_ratio,
          round(CAST(observed AS DOUBLE) / expected, 4) AS observed_ratio,
          round(CAST(observed AS DOUBLE) / emitted, 4) AS observed_per_emitted,
          CASE WHEN observed IS NULL THEN 'no observation' WHEN observed = expected THEN 'delivered once'
               WHEN observed = 2 * expected THEN 'delivered twice' ELSE 'unexpected' END AS verdict
        FROM counts""",
    "recovery_time": """WITH polls AS (
        SELECT user_id, event_id % 70 AS tick, CASE WHEN event_id % 70 >= user_id % 80
          THEN 1000 + user_id + event_id % 9 ELSE 1000 + user_id END AS value FROM events),
        runs AS (SELECT user_id, 1000 + user_id AS baseline,
          min(tick) FILTER (value <> 1000 + user_id AND tick BETWEEN 1 AND 60) AS recovery_s
          FROM polls GROUP BY user_id)
        SELECT concat('run-', user_id) AS run_id, baseline, recovery_s,
          recovery_s IS NULL AS recovery_timeout FROM runs""",
    "alert_latency": f"""{RUNS} SELECT run_id,
        CASE WHEN k % 5 <> 0 AND k % 3 <> 0 AND c % 4 >= 2 THEN 30 - c % 20
             WHEN c % 4 > 0 THEN 20 END AS e2e_latency_s,
        CASE WHEN k % 5 <> 0 AND k % 3 <> 0 AND c % 4 >= 2 THEN 'inject'
             WHEN c % 4 > 0 THEN 'fallback' ELSE 'no alert' END AS measured
        FROM runs WHERE scenario = 'D'""",
    "stream_persist_rows": f"""{TEL} SELECT device_id, frame AS frameIdentifier, t_emit AS t_emit_ms,
        round(CAST(engine AS DOUBLE), 3) AS engineTemperature, t_emit AS payload_t_emit
        FROM tel WHERE {GOOD}""",
    "stream_persist_counts": f"""{TEL}, c AS (SELECT count(*) AS received,
          count(*) FILTER ({GOOD}) AS persisted, count(*) FILTER (NOT {GOOD}) AS rejected,
          count(*) FILTER (seq % 6 = 5) AS bad, count(*) FILTER (seq % 6 IN (3, 4)) AS missing FROM tel)
        SELECT unnest(['received', 'persisted', 'rejected', 'invalid json', 'missing required fields'])
          AS stage, unnest([received, persisted, rejected, bad, missing]) AS messages FROM c""",
    "stream_window_native": f"""{TEL}, k AS (SELECT engine, tyre, arrival_ms AS t_emit,
        arrival_ms // {HOUR} AS key FROM tel)
        SELECT {WINDOW} FROM k WHERE key < (SELECT max(key) FROM k) GROUP BY key""",
    "stream_window_exact": f"{EXACT} SELECT {WINDOW_NAMES}, closed_at_ms, e2e_latency_ms FROM exact",
    "stream_window_counts": f"""{LATE} SELECT count(*) AS received,
        count(*) FILTER (NOT late) AS accepted, count(*) FILTER (late) AS late FROM lat""",
    "stream_alerts": f"""{EXACT} SELECT window_start, printf('{ALERT_TEXT}', window_start, window_end,
        count, raw_engine, raw_tyre, max_engine_temp, max_tyre_temp, e2e_latency_ms) AS line
        FROM exact WHERE raw_engine > 50""",
    "stream_flush": f"""{EXACT} SELECT {WINDOW}, {T0 + 10**12} AS closed_at_ms,
        {T0 + 10**12} - min(t_emit) AS e2e_latency_ms
        FROM acc WHERE key = (SELECT max(key) FROM acc) GROUP BY key""",
    "stream_message_windows": f"{EXACT_STRICT} SELECT {WINDOW_NAMES}, closed_at_ms, e2e_latency_ms FROM exact",
    "stream_readers": f"""{TEL}, c AS (SELECT count(*) AS n, count(*) FILTER ({GOOD}) AS good FROM tel)
        SELECT unnest(['persisted', 'persisted, counted', 'batches', 'received']) AS reader,
          unnest([good, good, 3, n]) AS messages FROM c""",
    "stream_progress": f"{TEL} SELECT CAST(3 AS BIGINT) AS batches, count(*) AS rows FROM tel",
}
# Written to files and read again, the facts are the same.
ORACLES["run_directories"] = ORACLES["run_facts"]
ORACLES["run_facts_bucketed"] = ORACLES["run_facts"]
SLICED = f"""{TEL}, cut AS (SELECT min(seq) AS low, (max(seq) - min(seq)) // 3 + 1 AS width FROM tel),
sliced AS (SELECT tel.*, (seq - low) // width AS slice FROM tel, cut)"""
ORACLES["stream_committed"] = f"""{SLICED}, c AS (SELECT count(*) AS n,
      count(*) FILTER ({GOOD}) AS good, count(*) FILTER ({GOOD} AND slice = 0) AS one,
      count(*) FILTER ({GOOD} AND slice < 2) AS two, count(*) FILTER (seq % 6 = 5) AS bad,
      count(*) FILTER (seq % 6 IN (3, 4)) AS missing FROM sliced)
    SELECT unnest(['batches committed: 1', 'second batch, written', 'batches committed: 2',
      'batches committed: 3', 'compacted', 'superseded files removed', 'attempts with files', 'received',
      'persisted', 'rejected', 'invalid json', 'missing required fields']) AS stage,
      unnest([one, one, two, good, good, good, 1, n, good, n - good, bad, missing]) AS messages FROM c"""
ORACLES["stream_observed"] = f"""{EXACT},
cut AS (SELECT min(seq) AS low, (max(seq) - min(seq)) // 3 + 1 AS width FROM tel),
per AS (SELECT (seq - low) // width AS batch_id, count(*) AS received, count(*) FILTER (NOT late) AS accepted,
    count(*) FILTER (late) AS late FROM lat, cut GROUP BY 1),
closer AS (SELECT key, (lead(s) OVER (ORDER BY key) - low) // width AS batch_id
  FROM (SELECT key, min(seq) AS s FROM acc GROUP BY key), cut),
done AS (SELECT batch_id, key, raw_engine, e2e_latency_ms AS ms FROM exact JOIN closer USING (key)),
bounds(le, b) AS (VALUES {BOUND_ROWS})
SELECT batch_id, metric, round(CAST(value AS DOUBLE), 4) AS value FROM (
  SELECT batch_id, unnest(['received', 'accepted', 'late']) AS metric, unnest([received, accepted, late]) AS value FROM per
  UNION ALL SELECT per.batch_id, 'latency_le_' || le, count(*) FILTER (ms / CAST(1000 AS DOUBLE) <= b)
    FROM per LEFT JOIN done ON per.batch_id = done.batch_id, bounds GROUP BY per.batch_id, le
  UNION ALL SELECT per.batch_id, 'latency_sum_ms', coalesce(sum(ms), 0)
    FROM per LEFT JOIN done ON per.batch_id = done.batch_id GROUP BY per.batch_id
  UNION ALL SELECT batch_id, 'latest_mean', arg_max(raw_engine, key) FROM done GROUP BY batch_id)
"""
ORACLES["stream_duplicates"] = f"""{REPEATED} SELECT CAST(2 * sum(n) AS BIGINT) AS total, count(*) AS distinct,
    CAST(sum(2 * n - 1) AS BIGINT) AS duplicates
    FROM (SELECT count(*) AS n FROM rep GROUP BY device_id, frame, t_emit)"""
ORACLES["stream_window_native_late"] = f"""{SLICED}, passed AS (
      SELECT slice + 1 AS slice, max(max(t_emit)) OVER (ORDER BY slice) AS mark FROM sliced GROUP BY slice)
    SELECT {WINDOW} FROM sliced LEFT JOIN passed USING (slice)
    WHERE coalesce(key * {HOUR} + {HOUR} > mark, true) AND key < (SELECT max(key) FROM tel) GROUP BY key"""
# While runs stream in, the same rows.
ORACLES["stream_alert_latency"] = ORACLES["alert_latency"]
ORACLES["stream_recovery"] = ORACLES["recovery_time"]
ORACLES["stream_backlog"] = f"""{TEL} SELECT unnest([0, 1, 2]) AS batch_id, unnest([2, 2, 1]) AS files_read,
    unnest([3, 1, 0]) AS files_left, unnest([false, false, true]) AS all_bytes_read, n AS rows_in_all
    FROM (SELECT count(*) AS n FROM tel)"""
ORACLES["stream_p95"] = f"""{TEL} SELECT pilot_index, count(*) AS rows, true AS within_error
    FROM tel GROUP BY pilot_index"""
