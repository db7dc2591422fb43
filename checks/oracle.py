"""DuckDB SQL for the registered queries, written apart from the Spark plans."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

EVENTS = """
base AS (
  SELECT event_id AS id, ts AS event_timestamp, user_id AS u,
         CAST(round(value * 100) AS BIGINT) AS v,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % 100 AS r
  FROM events),
timed AS (
  SELECT *, CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN 0
                 ELSE 3600000 + (k % 40) * 60000 END AS duration_ms FROM base),
placed AS (
  SELECT *, CASE WHEN id % 101 = 0 THEN NULL ELSE (v * 7919) %
       (CASE WHEN duration_ms > 0 THEN duration_ms ELSE 3600000 END) END AS position_ms FROM timed),
e AS (
  SELECT CAST(id AS VARCHAR) AS event_id,
    CASE WHEN r < 30 THEN 'PROGRESS' WHEN r < 45 THEN 'PLAY_START' WHEN r < 55 THEN 'PAUSE'
         WHEN r < 65 THEN 'RESUME' WHEN r < 75 THEN 'SEEK' WHEN r < 85 THEN 'QUALITY_CHANGE'
         WHEN r < 90 THEN 'REBUFFER_START' WHEN r < 95 THEN 'REBUFFER_END'
         ELSE 'PLAYBACK_END' END AS event_type,
    event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
    CAST(extract(hour FROM event_timestamp) AS INTEGER) AS event_hour,
    concat('user-', u) AS user_id,
    CASE WHEN u % 4 = 0 THEN NULL ELSE concat('profile-', u % 3) END AS profile_id,
    concat('device-', u) AS device_id,
    concat('s-', u, '-', strftime(event_timestamp, '%Y%m%d')) AS session_id,
    concat('content-', k % 40) AS content_id,
    CASE k % 4 WHEN 0 THEN 'movie' WHEN 1 THEN 'episode' WHEN 2 THEN 'documentary'
         ELSE NULL END AS content_type,
    CASE WHEN k % 10 = 0 THEN NULL ELSE concat('Title ', k % 40) END AS title,
    position_ms, duration_ms,
    CASE u % 7 WHEN 0 THEN 'IOS' WHEN 1 THEN 'ANDROID' WHEN 2 THEN 'WEB' WHEN 3 THEN 'SMART_TV'
         WHEN 4 THEN 'GAMING_CONSOLE' WHEN 5 THEN 'SET_TOP_BOX' ELSE NULL END AS device_type,
    CASE u % 7 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Web' WHEN 3 THEN 'Tizen'
         WHEN 4 THEN 'PlayStation OS' WHEN 5 THEN 'Roku OS' ELSE NULL END AS os_name,
    CASE WHEN u % 7 = 6 THEN NULL ELSE concat(u % 10, '.', u % 9) END AS os_version,
    CASE WHEN u % 7 = 6 THEN NULL WHEN u % 5 = 0 THEN 'US' WHEN u % 5 = 1 THEN 'GB'
         WHEN u % 5 = 2 THEN 'DE' WHEN u % 5 = 3 THEN 'FR' ELSE NULL END AS country,
    CASE WHEN u % 7 = 6 THEN NULL WHEN u % 3 = 0 THEN 'CA' ELSE 'NY' END AS region,
    CASE WHEN r >= 65 AND r < 75 THEN position_ms END AS seek_from_ms,
    CASE WHEN r >= 65 AND r < 75 THEN (id * 6007) % 3600000 END AS seek_to_ms,
    CASE WHEN r >= 75 AND r < 85 THEN
      CASE id % 6 WHEN 0 THEN 'AUTO' WHEN 1 THEN 'SD_480P' WHEN 2 THEN 'HD_720P'
           WHEN 3 THEN 'HD_1080P' WHEN 4 THEN 'UHD_4K' ELSE 'UHD_8K' END END AS old_quality,
    CASE WHEN r >= 75 AND r < 85 THEN
      CASE (k + 1) % 6 WHEN 0 THEN 'AUTO' WHEN 1 THEN 'SD_480P' WHEN 2 THEN 'HD_720P'
           WHEN 3 THEN 'HD_1080P' WHEN 4 THEN 'UHD_4K' ELSE 'UHD_8K' END END AS new_quality,
    CASE WHEN r >= 75 AND r < 85 THEN 1000 + (id * 29) % 20000 END AS new_bitrate,
    CASE WHEN r >= 75 AND r < 85 THEN id % 2 = 0 END AS automatic,
    CASE WHEN r < 30 THEN 1000 + (id * 31) % 15000 END AS current_bitrate,
    CASE WHEN r >= 75 AND r < 85 THEN 1000 + (id * 29) % 20000
         WHEN r < 30 THEN 1000 + (id * 31) % 15000 END AS bitrate_kbps,
    CASE WHEN r >= 85 AND r < 95 THEN 1000 + (id * 53) % 20000 END AS bandwidth_estimate,
    CASE WHEN r >= 90 AND r < 95 AND id % 11 <> 0 THEN (id * 37) % 10000
         END AS rebuffer_duration_ms,
    CASE WHEN r >= 95 THEN (id * 7919) % 3600000 END AS total_watch_time_ms,
    CASE WHEN r >= 95 AND duration_ms > 0 THEN position_ms * 100.0E0 / duration_ms
         END AS completion_percentage,
    CASE WHEN r >= 95 THEN CASE id % 6 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'USER_STOPPED'
         WHEN 2 THEN 'USER_EXIT' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'NETWORK_ERROR'
         ELSE 'APP_TERMINATED' END END AS end_reason
  FROM placed)"""

DEVICE_CLASS = """CASE WHEN device_type IN ('IOS', 'ANDROID') THEN 'mobile'
  WHEN device_type = 'WEB' THEN 'desktop'
  WHEN device_type IN ('SMART_TV', 'SET_TOP_BOX', 'GAMING_CONSOLE') THEN 'tv' ELSE 'other' END"""

PAYLOAD_TYPES = """('SEEK', 'QUALITY_CHANGE', 'REBUFFER_START', 'REBUFFER_END', 'PLAYBACK_END',
  'PROGRESS')"""

PROGRESS_VIEW = """
ranked_progress AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, content_id
                               ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM e
  WHERE event_type IN ('PLAY_START', 'PROGRESS', 'PAUSE', 'SEEK', 'PLAYBACK_END')
    AND position_ms IS NOT NULL AND duration_ms > 0),
progress AS (
  SELECT user_id, content_id, title, position_ms AS last_position, duration_ms AS duration,
         CASE WHEN event_type = 'PLAYBACK_END' AND completion_percentage IS NOT NULL
              THEN completion_percentage ELSE position_ms * 100.0E0 / duration_ms
              END AS completion_percentage,
         event_timestamp AS last_watched,
         CASE WHEN event_type = 'PLAYBACK_END' THEN coalesce(total_watch_time_ms, 0) ELSE 0
              END AS total_watch_time,
         session_id, coalesce(device_type, 'UNKNOWN') AS device_type, country
  FROM ranked_progress WHERE rn = 1)"""

CONTINUE_ROWS = """
continue_rows AS (
  SELECT user_id, event_timestamp AS last_watched, content_id, title,
         position_ms AS last_position, duration_ms AS duration, event_id,
         CASE WHEN event_type = 'PLAYBACK_END' AND completion_percentage IS NOT NULL
              THEN completion_percentage ELSE position_ms * 100.0E0 / duration_ms
              END AS completion_percentage
  FROM e WHERE event_type IN ('PROGRESS', 'PAUSE', 'PLAYBACK_END')
           AND position_ms IS NOT NULL AND duration_ms <> 0),
continue_log AS (
  SELECT * FROM continue_rows WHERE completion_percentage >= 2 AND completion_percentage < 95
  QUALIFY row_number() OVER (PARTITION BY user_id, last_watched, content_id
                             ORDER BY event_id DESC) = 1),
continue_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, content_id
                                ORDER BY last_watched DESC, event_id DESC) AS rn
                 FROM continue_rows)
  WHERE rn = 1 AND completion_percentage >= 2 AND completion_percentage < 95)"""

CONTINUE_COLUMNS = """user_id, last_watched, content_id, title, last_position, duration,
  round(completion_percentage, 9) AS completion_percentage"""
PROGRESS_COLUMNS = """user_id, content_id, title, last_position, duration,
  round(completion_percentage, 9) AS completion_percentage, last_watched, total_watch_time,
  session_id, device_type, country"""
USER_COLUMNS = """user_id, event_timestamp AS "timestamp", event_id, event_type, session_id,
  content_id, title, position_ms AS "position", duration_ms AS duration,
  coalesce(device_type, 'UNKNOWN') AS device_type"""
SESSION_COLUMNS = f"""session_id, date_trunc('millisecond', event_timestamp) AS "timestamp",
  event_id, event_type, user_id, content_id, title, position_ms AS "position",
  duration_ms AS duration, event_type IN {PAYLOAD_TYPES} AS has_payload"""
CONTENT_COLUMNS = """content_id, event_timestamp AS "timestamp", user_id, event_id, event_type,
  session_id, position_ms AS "position", coalesce(device_type, 'UNKNOWN') AS device_type, country"""
QUALITY_COLUMNS = """content_id, event_date, event_timestamp AS "timestamp", event_id, event_type,
  user_id, session_id, coalesce(device_type, 'UNKNOWN') AS device_type, country, old_quality,
  new_quality, coalesce(new_bitrate, bandwidth_estimate) AS bitrate,
  rebuffer_duration_ms AS rebuffer_duration"""
IS_QUALITY = "event_type IN ('QUALITY_CHANGE', 'REBUFFER_START', 'REBUFFER_END')"


def content_metrics(width: str, name: str = "metrics") -> str:
    start = "event_type = 'PLAY_START'"
    return f"""
{name} AS (
  SELECT content_id, window_start, window_start + INTERVAL {width} AS window_end, view_count,
    unique_viewers, completed_views, total_watch_time_ms,
    CASE WHEN view_count > 0 THEN total_watch_time_ms // view_count ELSE 0
         END AS avg_watch_time_ms,
    rebuffer_count, total_rebuffer_duration_ms, error_count, pause_count, seek_count,
    quality_change_count, mobile_views, desktop_views, tv_views, other_device_views
  FROM (
    SELECT content_id, time_bucket(INTERVAL {width}, event_timestamp) AS window_start,
      count(*) FILTER ({start}) AS view_count, count(DISTINCT user_id) AS unique_viewers,
      count(*) FILTER (event_type = 'PLAYBACK_END' AND completion_percentage >= 90)
        AS completed_views,
      CAST(coalesce(sum(total_watch_time_ms) FILTER (event_type = 'PLAYBACK_END'), 0) AS BIGINT)
        AS total_watch_time_ms,
      count(*) FILTER (event_type = 'REBUFFER_END') AS rebuffer_count,
      CAST(coalesce(sum(rebuffer_duration_ms) FILTER (event_type = 'REBUFFER_END'), 0) AS BIGINT)
        AS total_rebuffer_duration_ms,
      count(*) FILTER (end_reason IN ('ERROR', 'NETWORK_ERROR')) AS error_count,
      count(*) FILTER (event_type = 'PAUSE') AS pause_count,
      count(*) FILTER (event_type = 'SEEK') AS seek_count,
      count(*) FILTER (event_type = 'QUALITY_CHANGE') AS quality_change_count,
      count(*) FILTER ({start} AND device_type IN ('IOS', 'ANDROID')) AS mobile_views,
      count(*) FILTER ({start} AND device_type = 'WEB') AS desktop_views,
      count(*) FILTER ({start} AND device_type IN ('SMART_TV', 'SET_TOP_BOX', 'GAMING_CONSOLE'))
        AS tv_views,
      count(*) FILTER ({start} AND device_type IS NULL) AS other_device_views
    FROM e GROUP BY 1, 2))"""


def sessions(gap: str) -> str:
    return f"""
flagged AS (
  SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w <= INTERVAL {gap}
                 THEN 0 ELSE 1 END AS opens
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id
                             ROWS UNBOUNDED PRECEDING) AS session_no FROM flagged),
grouped AS (
  SELECT user_id, session_no, min(event_timestamp) AS session_start,
    max(event_timestamp) AS session_end,
    arg_min(coalesce(device_type, '-'), event_timestamp) AS device_type,
    count(DISTINCT content_id) AS content_count, count(*) AS total_events,
    CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS total_watch_time_ms,
    coalesce(avg(completion_percentage), 0) AS avg_completion_percentage,
    count(*) FILTER (event_type = 'PLAY_START') AS play_start_count,
    count(*) FILTER (event_type = 'PAUSE') AS pause_count,
    count(*) FILTER (event_type = 'SEEK') AS seek_count,
    count(*) FILTER (end_reason IN ('ERROR', 'NETWORK_ERROR')) AS error_count,
    count(*) FILTER (event_type = 'REBUFFER_END') AS rebuffer_count,
    CAST(coalesce(sum(rebuffer_duration_ms), 0) AS BIGINT) AS total_rebuffer_duration_ms
  FROM numbered GROUP BY user_id, session_no),
user_sessions AS (
  SELECT user_id, session_start,
    concat(user_id, '-', epoch_us(session_start) // 1000) AS session_id,
    nullif(device_type, '-') AS device_type,
    epoch_us(session_end) // 1000 - epoch_us(session_start) // 1000 AS session_duration_ms,
    content_count, total_events, total_watch_time_ms,
    round(avg_completion_percentage, 9) AS avg_completion_percentage,
    play_start_count, pause_count, seek_count, error_count, rebuffer_count,
    total_rebuffer_duration_ms
  FROM grouped)"""


def stats(keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS total_events,
    count(*) FILTER (event_type = 'PLAY_START') AS play_starts,
    count(*) FILTER (event_type = 'PLAYBACK_END') AS play_ends,
    count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
    CAST(sum(CASE WHEN event_type = 'PLAYBACK_END' THEN position_ms ELSE 0 END) AS BIGINT) // 1000
      AS total_watch_time_seconds,
    avg(bitrate_kbps) AS avg_bitrate_kbps,
    count(*) FILTER (event_type = 'REBUFFER_START') AS rebuffer_count,
    CAST(sum(CASE WHEN event_type = 'REBUFFER_END' THEN rebuffer_duration_ms ELSE 0 END) AS BIGINT)
      AS total_rebuffer_duration_ms,
    count(*) FILTER (event_type = 'QUALITY_CHANGE') AS quality_changes,
    count(*) FILTER (event_type = 'SEEK') AS seek_count,
    count(*) FILTER (event_type = 'PAUSE') AS pause_count,
    count(*) FILTER (device_type IN ('IOS', 'ANDROID')) AS mobile_events,
    count(*) FILTER (device_type IN ('SMART_TV', 'SET_TOP_BOX', 'GAMING_CONSOLE')) AS tv_events,
    count(*) FILTER (device_type = 'WEB') AS web_events,
    CAST(0 AS BIGINT) AS tablet_events
  FROM e"""


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLE_SQL[name] = "WITH " + ",".join([EVENTS, *ctes]) + "\n" + body


ROUND_STATS = "SELECT * REPLACE (round(avg_bitrate_kbps, 6) AS avg_bitrate_kbps) FROM "
HOURLY = f"hourly AS ({stats('content_id, event_date, event_hour')} GROUP BY ALL)"

# --- sources -----------------------------------------------------------------

FLAT = """event_id, event_type,
  date_trunc('millisecond', event_timestamp) AS event_timestamp, user_id, profile_id, device_id,
  session_id, content_id, content_type, title, position_ms, duration_ms, device_type, os_name,
  os_version, country, region"""
# What is wrong with the damaged records; right(event_id, 2) tells which were damaged and how.
REJECTED = """
  CASE lpad(right(event_id, 2), 2, '-')
    WHEN '07' THEN 'unreadable' WHEN '17' THEN 'missing userId' WHEN '27' THEN 'unknown eventType'
    WHEN '47' THEN CASE WHEN device_type IS NOT NULL THEN 'unknown deviceInfo.deviceType' END
    WHEN '67' THEN CASE WHEN seek_from_ms IS NOT NULL THEN 'missing payload.seek.toPosition' END
    WHEN '77' THEN 'unknown payload.qualityChange.newQuality'
    WHEN '98' THEN 'unknown payload.playbackEnd.reason' END"""
BAD = f"""bad AS (SELECT *, coalesce({REJECTED},
  CASE WHEN event_type = 'SEEK' AND seek_from_ms IS NULL
         THEN 'missing payload.seek.fromPosition'
       WHEN event_type = 'PLAYBACK_END' AND position_ms IS NULL
         THEN 'missing payload.playbackEnd.finalPosition'
       WHEN event_type = 'PLAYBACK_END' AND completion_percentage IS NULL
         THEN 'missing payload.playbackEnd.completionPercentage' END) AS reject_reason FROM e)"""
oracle("decode_events", f"""
SELECT {FLAT}, seek_from_ms, seek_to_ms, old_quality, new_quality, new_bitrate, automatic,
  current_bitrate, bitrate_kbps, bandwidth_estimate, rebuffer_duration_ms, total_watch_time_ms,
  round(completion_percentage, 9) AS completion_percentage, end_reason,
  event_type IN {PAYLOAD_TYPES} AS has_payload
FROM bad AS e WHERE reject_reason IS NULL""", BAD)
oracle("quarantine", """
SELECT reject_reason, count(*) AS rows,
  min(date_trunc('millisecond', event_timestamp)) AS first_received,
  max(date_trunc('millisecond', event_timestamp)) AS last_received
FROM bad WHERE reject_reason IS NOT NULL GROUP BY 1""", BAD)
oracle("hot_cold_join", """
SELECT p.user_id, p.content_id, p.last_position, p.last_watched, h.history_events, h.first_seen
FROM progress p JOIN (SELECT user_id, content_id, count(*) AS history_events,
                             min(event_timestamp) AS first_seen FROM e GROUP BY 1, 2) h
  ON p.user_id = h.user_id AND p.content_id = h.content_id""", PROGRESS_VIEW)

# --- hot views and history -----------------------------------------------------

oracle("events_by_user", f"SELECT {USER_COLUMNS} FROM e")
oracle("events_by_session", f"SELECT {SESSION_COLUMNS} FROM e")
oracle("events_by_content", f"SELECT {CONTENT_COLUMNS} FROM e")
oracle("user_content_progress", f"SELECT {PROGRESS_COLUMNS} FROM progress", PROGRESS_VIEW)
oracle("continue_watching_log", f"SELECT {CONTINUE_COLUMNS} FROM continue_log", CONTINUE_ROWS)
oracle("continue_watching_latest", f"SELECT {CONTINUE_COLUMNS} FROM continue_latest",
       CONTINUE_ROWS)
oracle("quality_events", f"SELECT {QUALITY_COLUMNS} FROM e WHERE {IS_QUALITY}")
oracle("history_events", f"""
SELECT {FLAT}, event_type IN {PAYLOAD_TYPES} AS has_payload, event_date, event_hour, bitrate_kbps,
  rebuffer_duration_ms FROM e""")
oracle("route_counts", f"""
SELECT 'events_by_user' AS table_name, count(*) AS accepted_rows FROM e
UNION ALL SELECT 'events_by_session', count(*) FROM e
UNION ALL SELECT 'events_by_content', count(*) FROM e
UNION ALL SELECT 'user_content_progress', count(*) FROM ranked_progress
UNION ALL SELECT 'continue_watching', count(*) FROM continue_rows
  WHERE completion_percentage >= 2 AND completion_percentage < 95
UNION ALL SELECT 'playback_quality_events', count(*) FROM e WHERE {IS_QUALITY}""",
       PROGRESS_VIEW, CONTINUE_ROWS)
oracle("progress_display", """
SELECT user_id, content_id,
  concat(last_position // 60000, ':', lpad(CAST(last_position // 1000 % 60 AS VARCHAR), 2, '0'))
    AS position_text,
  concat(duration // 60000, ':', lpad(CAST(duration // 1000 % 60 AS VARCHAR), 2, '0'))
    AS duration_text,
  greatest(0, duration - last_position) AS remaining_ms
FROM progress""", PROGRESS_VIEW)
oracle("continue_watching_display", """
SELECT user_id, last_watched, content_id, title,
  concat(last_position // 60000, ':', lpad(CAST(last_position // 1000 % 60 AS VARCHAR), 2, '0'))
    AS position_text,
  CASE WHEN left_s >= 3600 THEN concat(left_s // 3600, 'h ', left_s % 3600 // 60, 'm left')
       ELSE concat(left_s // 60, 'm left') END AS remaining_text
FROM (SELECT *, greatest(0, duration - last_position) // 1000 AS left_s FROM continue_latest)""",
       CONTINUE_ROWS)
oracle("retention_apply", f"""
SELECT {USER_COLUMNS} FROM e
WHERE event_timestamp >= TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAYS""")

# --- metrics and sessions ---------------------------------------------------------

oracle("content_metrics_5min", "SELECT * FROM metrics", content_metrics("5 minutes"))
oracle("content_metrics_early", "SELECT * FROM metrics", content_metrics("5 minutes"))
oracle("replay_content_metrics", "SELECT * FROM metrics", content_metrics("5 minutes"))
oracle("viewers_rollup_sketch", """
SELECT content_id, date_trunc('hour', event_timestamp) AS window_start,
  count(DISTINCT user_id) AS approx_viewers FROM e GROUP BY 1, 2""")
oracle("viewers_rollup", """
SELECT content_id, date_trunc('hour', event_timestamp) AS hour_start,
  count(DISTINCT user_id) AS unique_viewers FROM e GROUP BY 1, 2""")
oracle("device_class_counts", f"""
SELECT {DEVICE_CLASS} AS device_class, count(*) AS events,
  count(*) FILTER (event_type = 'PLAY_START') AS views FROM e GROUP BY 1""")
oracle("qos_anomalies", """
SELECT content_id, window_start, round(ratio, 9) AS rebuffer_ratio,
  round(mean_before, 9) AS mean_before, round(std_before, 9) AS std_before, windows_before,
  coalesce(abs(ratio - mean_before) > 3 * std_before, false) AS is_anomaly
FROM (
  SELECT *, avg(ratio) OVER w AS mean_before, stddev_samp(ratio) OVER w AS std_before,
    count(ratio) OVER w AS windows_before
  FROM (SELECT content_id, window_start,
          total_rebuffer_duration_ms / CAST(total_watch_time_ms AS DOUBLE) AS ratio
        FROM metrics WHERE total_watch_time_ms > 0)
  WINDOW w AS (PARTITION BY content_id ORDER BY window_start
               ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))""", content_metrics("1 hour"))
oracle("user_sessions", "SELECT * FROM user_sessions", sessions("30 minutes"))
oracle("user_sessions_12h", "SELECT * FROM user_sessions", sessions("12 hours"))
oracle("user_sessions_window", "SELECT * FROM user_sessions", sessions("12 hours"))
oracle("sessions_by_lag", "SELECT user_id, session_start, session_id FROM user_sessions",
       sessions("12 hours"))


def distribution(rows: str, points: tuple[int, ...] = (50, 95, 99)) -> str:
    at = ", ".join(f"quantile_disc(value, {p / 100}) AS p{p:02d}" for p in points)
    return f"""
SELECT measure, count(*) AS samples, min(value) AS min_value, max(value) AS max_value,
  round(avg(value), 6) AS mean_value, {at}
FROM ({rows}) WHERE value IS NOT NULL GROUP BY measure"""


oracle("session_distribution", distribution("""
  SELECT 'duration_seconds' AS measure, session_duration_ms // 1000 AS value FROM user_sessions
  UNION ALL SELECT 'events', total_events FROM user_sessions
  UNION ALL SELECT 'contents', content_count FROM user_sessions
  UNION ALL SELECT 'watch_seconds', total_watch_time_ms // 1000 FROM user_sessions"""),
       sessions("12 hours"))
oracle("window_distribution", distribution("""
  SELECT 'views' AS measure, view_count AS value FROM metrics
  UNION ALL SELECT 'unique_viewers', unique_viewers FROM metrics
  UNION ALL SELECT 'watch_minutes', total_watch_time_ms // 60000 FROM metrics
  UNION ALL SELECT 'completion_rate_percent', completed_views * 100 // nullif(view_count, 0) FROM metrics
    WHERE view_count > 0"""), content_metrics("5 minutes"))
oracle("completion_distribution", distribution("""
  SELECT 'completion_percent' AS measure, CAST(floor(completion_percentage) AS BIGINT) AS value
  FROM e WHERE event_type = 'PLAYBACK_END'"""))

# --- roll-ups -------------------------------------------------------------------------

oracle("hourly_content_stats", ROUND_STATS + """hourly
WHERE event_date = DATE '2024-01-05' AND event_hour = 20""", HOURLY)
oracle("backfill_hourly", ROUND_STATS + """hourly
WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""", HOURLY)
oracle("daily_content_stats_exact", ROUND_STATS + "daily",
       f"daily AS ({stats('content_id, event_date')} GROUP BY ALL)")
PEAK = """
peak AS (
  SELECT content_id, event_date, event_hour AS peak_hour, total_events AS peak_hour_events
  FROM hourly QUALIFY row_number() OVER (PARTITION BY content_id, event_date
                                         ORDER BY total_events DESC, event_hour) = 1)"""
oracle("peak_hour", "SELECT * FROM peak", HOURLY, PEAK)
oracle("daily_content_stats", """
SELECT d.* EXCLUDE (mobile, tv, web, tablet), p.peak_hour, p.peak_hour_events,
  round(CASE WHEN mobile + tv + web + tablet > 0
             THEN mobile / CAST(mobile + tv + web + tablet AS DOUBLE) ELSE 0 END, 9)
    AS mobile_ratio,
  round(CASE WHEN mobile + tv + web + tablet > 0
             THEN tv / CAST(mobile + tv + web + tablet AS DOUBLE) ELSE 0 END, 9) AS tv_ratio,
  round(CASE WHEN mobile + tv + web + tablet > 0
             THEN web / CAST(mobile + tv + web + tablet AS DOUBLE) ELSE 0 END, 9) AS web_ratio,
  round(CASE WHEN mobile + tv + web + tablet > 0
             THEN tablet / CAST(mobile + tv + web + tablet AS DOUBLE) ELSE 0 END, 9)
    AS tablet_ratio
FROM (
  SELECT content_id, event_date, CAST(sum(total_events) AS BIGINT) AS total_events,
    CAST(sum(play_starts) AS BIGINT) AS play_starts, CAST(sum(play_ends) AS BIGINT) AS play_ends,
    max(unique_users) AS unique_users, max(unique_sessions) AS unique_sessions,
    CAST(sum(total_watch_time_seconds) AS BIGINT) AS total_watch_time_seconds,
    round(avg(avg_bitrate_kbps), 6) AS avg_bitrate_kbps,
    CAST(sum(rebuffer_count) AS BIGINT) AS total_rebuffer_count,
    CAST(sum(total_rebuffer_duration_ms) AS BIGINT) AS total_rebuffer_duration_ms,
    CAST(sum(quality_changes) AS BIGINT) AS quality_changes,
    CAST(sum(seek_count) AS BIGINT) AS seek_count, CAST(sum(pause_count) AS BIGINT) AS pause_count,
    CAST(sum(mobile_events) AS BIGINT) AS mobile, CAST(sum(tv_events) AS BIGINT) AS tv,
    CAST(sum(web_events) AS BIGINT) AS web, CAST(sum(tablet_events) AS BIGINT) AS tablet
  FROM hourly GROUP BY 1, 2) d
LEFT JOIN peak p ON d.content_id = p.content_id AND d.event_date = p.event_date""", HOURLY, PEAK)

# --- reports ----------------------------------------------------------------------------

oracle("event_overview", """
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions, count(DISTINCT content_id) AS unique_content,
  min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM e""")
oracle("event_type_share", """
SELECT event_type, count(*) AS event_count,
  round(count(*) * 100.0E0 / (SELECT count(*) FROM e), 2) AS percentage FROM e GROUP BY 1""")
oracle("device_analytics", """
SELECT device_type, count(*) AS events, count(DISTINCT user_id) AS users,
  round(avg(bitrate_kbps), 0) AS avg_bitrate FROM e GROUP BY 1""")
oracle("hourly_traffic", """
SELECT event_hour, count(*) AS events, count(DISTINCT user_id) AS unique_users
FROM e GROUP BY 1""")
oracle("top_content", """
SELECT content_id, count(*) AS total_events,
  count(*) FILTER (event_type = 'PLAY_START') AS play_starts,
  count(DISTINCT user_id) AS unique_viewers, round(avg(bitrate_kbps), 0) AS avg_bitrate
FROM e GROUP BY 1 ORDER BY play_starts DESC, content_id LIMIT 10""")
oracle("rebuffer_top", """
SELECT content_id, count(*) AS rebuffer_events,
  round(avg(rebuffer_duration_ms), 6) AS avg_rebuffer_ms,
  max(rebuffer_duration_ms) AS max_rebuffer_ms
FROM e WHERE event_type IN ('REBUFFER_START', 'REBUFFER_END') GROUP BY 1
ORDER BY rebuffer_events DESC, content_id LIMIT 10""")
oracle("event_counters", """
SELECT 'events_processed' AS counter, count(*) AS value FROM e
UNION ALL SELECT 'play_starts', count(*) FROM e WHERE event_type = 'PLAY_START'
UNION ALL SELECT 'playback_ends', count(*) FROM e WHERE event_type = 'PLAYBACK_END'
UNION ALL SELECT 'pauses', count(*) FROM e WHERE event_type = 'PAUSE'
UNION ALL SELECT 'seeks', count(*) FROM e WHERE event_type = 'SEEK'
UNION ALL SELECT 'rebuffers', count(*) FROM e WHERE event_type LIKE 'REBUFFER%'
UNION ALL SELECT 'quality_changes', count(*) FROM e WHERE event_type = 'QUALITY_CHANGE'
UNION ALL SELECT 'errors', count(*) FROM e WHERE end_reason IN ('ERROR', 'NETWORK_ERROR')""")
oracle("business_totals", """
SELECT count(*) FILTER (event_type = 'PLAY_START') AS playbacks_started,
  count(*) FILTER (completion_percentage >= 90) AS playbacks_completed,
  CAST(coalesce(sum(total_watch_time_ms // 1000), 0) AS BIGINT) AS watch_time_seconds,
  CAST(coalesce(sum(rebuffer_duration_ms), 0) AS BIGINT) AS rebuffer_duration_ms FROM e""")
oracle("bitrate_distribution", distribution("""
  SELECT 'bitrate_kbps' AS measure, bitrate_kbps AS value FROM e
  UNION ALL SELECT 'progress_bitrate_kbps', current_bitrate FROM e
  UNION ALL SELECT 'switched_bitrate_kbps', new_bitrate FROM e""", (5, 25, 50, 75, 95)))
for _name, _key in (("completion_by_device", "coalesce(device_type, 'UNKNOWN') AS device_type"),
                    ("completion_by_content", "content_id")):
    oracle(_name, f"""
SELECT *, CASE WHEN play_ends > 0 THEN round(completed / CAST(play_ends AS DOUBLE), 9)
               END AS completion_rate
FROM (SELECT {_key}, count(*) FILTER (event_type = 'PLAY_START') AS play_starts,
        count(*) FILTER (event_type = 'PLAYBACK_END') AS play_ends,
        count(*) FILTER (completion_percentage >= 90) AS completed,
        round(avg(completion_percentage), 9) AS avg_completion_percentage
      FROM e GROUP BY ALL)""")
oracle("device_behaviour", f"""
SELECT *, CASE WHEN views > 0 THEN round(pauses / CAST(views AS DOUBLE), 9) ELSE 0
               END AS pauses_per_view,
  CASE WHEN views > 0 THEN round(seeks / CAST(views AS DOUBLE), 9) ELSE 0 END AS seeks_per_view,
  CASE WHEN views > 0 THEN round(watch_time_ms / 60000.0E0 / views, 9) ELSE 0
       END AS watch_minutes_per_view
FROM (SELECT {DEVICE_CLASS} AS device_class,
        count(*) FILTER (event_type = 'PLAY_START') AS views,
        count(*) FILTER (event_type = 'PAUSE') AS pauses,
        count(*) FILTER (event_type = 'SEEK') AS seeks,
        CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS watch_time_ms,
        count(DISTINCT user_id) AS viewers FROM e GROUP BY 1)""")
oracle("engagement_by_hour", """
SELECT *, CAST(rank() OVER (ORDER BY watch_time_ms DESC) AS INTEGER) AS engagement_rank
FROM (SELECT event_hour, count(*) FILTER (event_type = 'PLAY_START') AS views,
        count(DISTINCT user_id) AS viewers,
        CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS watch_time_ms
      FROM e GROUP BY 1)""")
oracle("title_viewers_day", """
SELECT content_id, event_date, count(DISTINCT user_id) AS viewers,
  count(*) FILTER (event_type = 'PLAY_START') AS views FROM e GROUP BY 1, 2""")
oracle("seek_patterns", """
SELECT content_id, count(*) AS seeks, count(*) FILTER (d > 0) AS forward_seeks,
  count(*) FILTER (d < 0) AS backward_seeks, round(avg(d) FILTER (d > 0), 6) AS avg_forward_ms,
  round(avg(-d) FILTER (d < 0), 6) AS avg_backward_ms
FROM (SELECT content_id, seek_to_ms - seek_from_ms AS d FROM e WHERE event_type = 'SEEK')
GROUP BY 1""")
oracle("period_report", "\nUNION ALL\n".join(f"""
SELECT '{_period}' AS period, CAST(date_trunc('{_period}', event_date) AS DATE) AS period_start,
  count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  count(*) FILTER (event_type = 'PLAY_START') AS play_starts,
  count(*) FILTER (completion_percentage >= 90) AS completed_views,
  CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS watch_time_ms,
  CAST(coalesce(sum(rebuffer_duration_ms), 0) AS BIGINT) AS rebuffer_ms
FROM e GROUP BY 2""" for _period in ("day", "week", "month", "quarter")))
oracle("user_features", """
SELECT user_id, date_diff('day', CAST(max(event_timestamp) AS DATE), DATE '2024-01-31')
    AS recency_days,
  count(DISTINCT event_date) AS active_days, count(DISTINCT session_id) AS sessions,
  count(DISTINCT content_id) AS contents, count(DISTINCT device_type) AS device_types,
  count(*) AS total_events, count(*) FILTER (event_type = 'PLAY_START') AS play_starts,
  count(*) FILTER (completion_percentage >= 90) AS completed_views,
  CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS watch_time_ms,
  count(*) FILTER (event_type = 'REBUFFER_START') AS rebuffers,
  CASE WHEN count(*) FILTER (event_type = 'PLAYBACK_END') > 0 THEN
    round(count(*) FILTER (completion_percentage >= 90)
          / CAST(count(*) FILTER (event_type = 'PLAYBACK_END') AS DOUBLE), 9)
    ELSE 0 END AS completion_rate
FROM e GROUP BY 1""")
oracle("user_content_matrix", """
SELECT user_id, content_id, count(*) AS interactions,
  count(*) FILTER (event_type = 'PLAY_START') AS views,
  CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS watch_time_ms,
  round(max(completion_percentage), 9) AS best_completion,
  max(event_timestamp) AS last_interaction FROM e GROUP BY 1, 2""")

# --- quality of service -------------------------------------------------------------------

QOS = """CAST(coalesce(sum(rebuffer_duration_ms), 0) AS BIGINT) AS rebuffer_ms,
  CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS play_ms,
  count(*) FILTER (event_type = 'REBUFFER_END') AS rebuffer_count,
  round(avg(bitrate_kbps), 6) AS avg_bitrate_kbps,
  CASE WHEN sum(total_watch_time_ms) > 0 THEN
    round(coalesce(sum(rebuffer_duration_ms), 0) / CAST(sum(total_watch_time_ms) AS DOUBLE), 9)
    END AS rebuffer_ratio"""
oracle("qos_by_content", f"SELECT content_id, {QOS} FROM e GROUP BY content_id")
oracle("qos_by_device", f"""SELECT coalesce(device_type, 'UNKNOWN') AS device_type, {QOS} FROM e
GROUP BY ALL""")
oracle("qos_by_region", f"SELECT country, region, {QOS} FROM e GROUP BY country, region")
oracle("qos_realtime", f"""
SELECT content_id, count(DISTINCT user_id) AS viewers, {QOS} FROM latest GROUP BY content_id
UNION ALL SELECT 'ALL', count(DISTINCT user_id), {QOS} FROM latest""", """
latest AS (SELECT * FROM e WHERE event_timestamp >=
  (SELECT time_bucket(INTERVAL 5 MINUTES, max(event_timestamp)) FROM e))""")
oracle("time_to_first_frame", """
SELECT s.session_id, s.content_id, s.started_at, min(p.event_timestamp) AS first_frame_at,
  epoch_us(min(p.event_timestamp)) // 1000 - epoch_us(s.started_at) // 1000 AS first_frame_ms
FROM (SELECT session_id, content_id, min(event_timestamp) AS started_at,
        arg_min(event_id, (event_timestamp, event_id)) AS start_id
      FROM e WHERE event_type = 'PLAY_START' GROUP BY 1, 2) s
JOIN e p ON p.session_id = s.session_id AND p.content_id = s.content_id
  AND p.event_type = 'PROGRESS'
  AND (p.event_timestamp > s.started_at
       OR (p.event_timestamp = s.started_at AND p.event_id > s.start_id))
GROUP BY 1, 2, 3""")
oracle("pause_durations", """
SELECT session_id, user_id, event_id AS resume_event_id, prev_at AS paused_at,
  event_timestamp AS resumed_at, epoch_us(event_timestamp) // 1000 - epoch_us(prev_at) // 1000 AS pause_ms
FROM (SELECT *, lag(event_type) OVER w AS prev_type, lag(event_timestamp) OVER w AS prev_at
      FROM e WHERE event_type IN ('PAUSE', 'RESUME')
      WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id))
WHERE event_type = 'RESUME' AND prev_type = 'PAUSE'""")
oracle("quality_stability", """
SELECT *, CASE WHEN play_ms > 0 THEN round(quality_changes * 3600000.0E0 / play_ms, 9)
               END AS changes_per_hour,
  CASE WHEN quality_changes > 0
       THEN round(automatic_changes / CAST(quality_changes AS DOUBLE), 9) END AS automatic_share
FROM (SELECT content_id, count(*) FILTER (event_type = 'QUALITY_CHANGE') AS quality_changes,
        count(*) FILTER (event_type = 'QUALITY_CHANGE' AND automatic) AS automatic_changes,
        CAST(coalesce(sum(total_watch_time_ms), 0) AS BIGINT) AS play_ms FROM e GROUP BY 1)""")
oracle("error_rates", """
SELECT *, CASE WHEN play_ends > 0 THEN round(error_ends / CAST(play_ends AS DOUBLE), 9)
               END AS error_rate,
  round((sessions - failed_sessions) / CAST(sessions AS DOUBLE), 9) AS session_success_rate
FROM (SELECT country, count(*) FILTER (event_type = 'PLAYBACK_END') AS play_ends,
        count(*) FILTER (end_reason IN ('ERROR', 'NETWORK_ERROR')) AS error_ends,
        count(DISTINCT session_id) AS sessions,
        count(DISTINCT session_id) FILTER (end_reason IN ('ERROR', 'NETWORK_ERROR'))
          AS failed_sessions
      FROM e GROUP BY 1)""")
oracle("content_health", """
SELECT content_id, round(rebuffer_ratio, 9) AS rebuffer_ratio, round(error_rate, 9) AS error_rate,
  round(completion_rate, 9) AS completion_rate, rebuffer_rank, error_rank, completion_rank,
  rebuffer_rank + error_rank + completion_rank AS rank_sum,
  rank() OVER (ORDER BY rebuffer_rank + error_rank + completion_rank) AS health_rank
FROM (
  SELECT *, rank() OVER (ORDER BY rebuffer_ratio DESC) AS rebuffer_rank,
    rank() OVER (ORDER BY error_rate DESC) AS error_rank,
    rank() OVER (ORDER BY completion_rate) AS completion_rank
  FROM (
    SELECT content_id,
      CASE WHEN sum(total_watch_time_ms) > 0
           THEN coalesce(sum(rebuffer_duration_ms), 0) / CAST(sum(total_watch_time_ms) AS DOUBLE)
           ELSE 0 END AS rebuffer_ratio,
      CASE WHEN count(end_reason) > 0
           THEN count(*) FILTER (end_reason IN ('ERROR', 'NETWORK_ERROR'))
                / CAST(count(end_reason) AS DOUBLE) ELSE 0 END AS error_rate,
      CASE WHEN count(end_reason) > 0
           THEN count(*) FILTER (completion_percentage >= 90) / CAST(count(end_reason) AS DOUBLE)
           ELSE 0 END AS completion_rate
    FROM e GROUP BY 1))""")

# --- lookups ----------------------------------------------------------------------------

oracle("lookup_continue_watching", f"""
SELECT {CONTINUE_COLUMNS} FROM continue_log c WHERE user_id = 'user-1'
ORDER BY c.last_watched DESC, c.content_id LIMIT 20""", CONTINUE_ROWS)
oracle("lookup_progress", f"""SELECT {PROGRESS_COLUMNS} FROM progress
WHERE user_id = 'user-1' AND content_id = 'content-1'""", PROGRESS_VIEW)
oracle("lookup_all_progress", f"SELECT {PROGRESS_COLUMNS} FROM progress WHERE user_id = 'user-1'",
       PROGRESS_VIEW)
ORACLE_SQL["stored_progress"] = ORACLE_SQL["user_content_progress"]
ORACLE_SQL["stored_lookup_all_progress"] = ORACLE_SQL["lookup_all_progress"]
oracle("lookup_user_events", f"""SELECT {USER_COLUMNS} FROM e WHERE user_id = 'user-1'
ORDER BY e.event_timestamp DESC, e.event_id LIMIT 100""")
oracle("lookup_session_events", f"""SELECT {SESSION_COLUMNS} FROM e
WHERE session_id = 's-1-20240105'""")
oracle("lookup_content_events", f"""SELECT {CONTENT_COLUMNS} FROM e WHERE content_id = 'content-1'
ORDER BY e.event_timestamp DESC, e.user_id, e.event_id LIMIT 100""")
ORACLE_SQL["stored_lookup_content_events"] = ORACLE_SQL["lookup_content_events"]
oracle("lookup_content_metrics", """SELECT * FROM metrics WHERE content_id = 'content-1'
ORDER BY window_start DESC LIMIT 100""", content_metrics("5 minutes"))
oracle("lookup_quality_events", f"""SELECT {QUALITY_COLUMNS} FROM e
WHERE {IS_QUALITY} AND content_id = 'content-1' AND event_date = DATE '2024-01-05'""")
oracle("lookup_user_sessions", """SELECT * FROM user_sessions WHERE user_id = 'user-1'
ORDER BY session_start DESC, session_id LIMIT 100""", sessions("30 minutes"))
oracle("continue_watching_top20", f"""
SELECT {CONTINUE_COLUMNS}, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_watched DESC, content_id)
    AS row_no FROM continue_log) WHERE row_no <= 20""", CONTINUE_ROWS)
oracle("user_timeline_top", f"""
SELECT {USER_COLUMNS}, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id)
    AS row_no FROM e) WHERE row_no <= 100""")
oracle("smart_resume", """
SELECT user_id, content_id, last_position,
  round(completion_percentage, 9) AS completion_percentage,
  completion_percentage >= 90 AS is_completed,
  CASE WHEN completion_percentage >= 90 OR last_position < 120000 THEN 0
       ELSE last_position - 10000 END AS resume_position,
  NOT (completion_percentage >= 90 OR last_position < 120000) AS show_prompt
FROM progress""", PROGRESS_VIEW)
oracle("active_sessions", """
SELECT user_id, session_id, content_id, event_type, position_ms, event_timestamp AS last_event_at
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                   ORDER BY event_timestamp DESC, event_id DESC) AS rn
      FROM e WHERE event_timestamp <= TIMESTAMP '2024-01-31 00:00:00')
WHERE rn = 1 AND event_type <> 'PLAYBACK_END'
  AND event_timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 4 HOURS""")

# --- joins ----------------------------------------------------------------------------------

oracle("enrich_content", """
SELECT event_id, e.content_id, coalesce(title, c.name) AS title, genre,
  coalesce(duration_ms, c.length_ms) AS duration_ms
FROM e LEFT JOIN (
  SELECT concat('content-', p_partkey % 40) AS content_id, min(p_name) AS name,
    min(p_type) AS genre, max(CAST(p_size AS BIGINT) * 60000) AS length_ms
  FROM part GROUP BY 1) c ON e.content_id = c.content_id""")
oracle("enrich_content_as_of", """
SELECT event_id, e.content_id, coalesce(title, v.name) AS title, genre,
  coalesce(duration_ms, v.length_ms) AS duration_ms, credits_ms
FROM e ASOF LEFT JOIN versions v
  ON e.content_id = v.content_id AND e.event_timestamp >= v.valid_from""", """versions AS (
  SELECT concat('content-', p_partkey % 40) AS content_id,
    DATE '2024-01-01' + CAST(p_partkey % 28 AS INTEGER) AS valid_from, min(p_name) AS name,
    min(p_type) AS genre, max(CAST(p_size AS BIGINT) * 60000) AS length_ms,
    max(CAST(p_size AS BIGINT) * 60000) - min(CAST(p_size AS BIGINT) * 60000) // 20 AS credits_ms
  FROM part GROUP BY 1, 2)""")
oracle("content_differences", """
SELECT event_id, event_date AS day, 'only_left' AS "column", '1' AS left_value,
  CAST(NULL AS VARCHAR) AS right_value FROM e WHERE right(event_id, 3) = '111'
UNION ALL
SELECT event_id, event_date, 'position', CAST(position_ms AS VARCHAR), '-1'
FROM e WHERE right(event_id, 3) = '222'""")
oracle("enrich_device", """
SELECT event_id, device_id, device_type, c_mktsegment AS device_model
FROM e LEFT JOIN customer ON device_id = concat('device-', c_custkey)""")
oracle("hot_cold_reconcile", """
SELECT content_id, event_date, hot_rows, cold_rows,
  CASE WHEN hot_rows IS NULL THEN 'only_cold' WHEN hot_rows = cold_rows THEN 'match'
       ELSE 'differs' END AS status
FROM (SELECT content_id, event_date,
        nullif(count(*) FILTER (event_timestamp >=
          TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAYS), 0) AS hot_rows,
        count(*) AS cold_rows FROM e GROUP BY 1, 2)""")

# --- data checks --------------------------------------------------------------------------

oracle("dedup_events", """
SELECT DISTINCT event_id, event_type, event_timestamp, user_id, content_id
FROM (SELECT * FROM e UNION ALL SELECT * FROM e)""")
oracle("noisy_devices", """
SELECT device_id, date_trunc('minute', event_timestamp) AS window_start, count(*) AS events
FROM e GROUP BY 1, 2 HAVING count(*) > 1""")
oracle("noisy_devices_sliding", """
SELECT device_id, window_start, count(*) AS events
FROM (SELECT device_id, time_bucket(INTERVAL 30 MINUTES, event_timestamp)
               - CAST(n AS INTEGER) * INTERVAL 30 MINUTES AS window_start
      FROM e, (SELECT unnest([0, 1]) AS n)) GROUP BY 1, 2 HAVING count(*) > 2""")
RULES = {
    "event_id present": "event_id IS NULL", "event_type present": "event_type IS NULL",
    "event_timestamp present": "event_timestamp IS NULL", "user_id present": "user_id IS NULL",
    "device_id present": "device_id IS NULL", "session_id present": "session_id IS NULL",
    "content_id present": "content_id IS NULL",
    "event_type known": """event_type NOT IN ('PLAY_START', 'PAUSE', 'RESUME', 'SEEK', 'PROGRESS',
      'QUALITY_CHANGE', 'REBUFFER_START', 'REBUFFER_END', 'PLAYBACK_END')""",
    "device_type known": """device_type NOT IN ('IOS', 'ANDROID', 'WEB', 'SMART_TV',
      'GAMING_CONSOLE', 'SET_TOP_BOX')""",
    "quality known": """old_quality NOT IN ('AUTO', 'SD_480P', 'HD_720P', 'HD_1080P', 'UHD_4K',
      'UHD_8K') OR new_quality NOT IN ('AUTO', 'SD_480P', 'HD_720P', 'HD_1080P', 'UHD_4K',
      'UHD_8K')""",
    "end_reason known": """end_reason NOT IN ('COMPLETED', 'USER_STOPPED', 'USER_EXIT', 'ERROR',
      'NETWORK_ERROR', 'APP_TERMINATED')""",
    "position in range": "position_ms < 0 OR position_ms > duration_ms",
}
CHECKS = "checks AS (" + "\nUNION ALL ".join(
    f"SELECT (SELECT count(*) FROM e) AS rows_checked, '{_rule}' AS rule, count(*) AS violations "
    f"FROM e WHERE {_broken}" for _rule, _broken in RULES.items()) + ")"
VOLUME = """
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(event_timestamp)),
                                date_trunc('hour', max(event_timestamp)), INTERVAL 1 HOUR))
    AS hour_start FROM e),
counted AS (
  SELECT hour_start, count(event_id) AS events
  FROM hours LEFT JOIN e ON date_trunc('hour', event_timestamp) = hour_start GROUP BY 1),
compared AS (
  SELECT hour_start, events, avg(events) OVER (ORDER BY hour_start
                             ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS expected
  FROM counted),
volume AS (
  SELECT hour_start, events, round(expected, 9) AS expected,
    coalesce(abs(events - expected) <= 0.2E0 * expected, true) AS within_tolerance
  FROM compared)"""
oracle("dq_required_fields", "SELECT * FROM checks", CHECKS)
oracle("dq_freshness", """
SELECT max(event_timestamp) AS latest_event,
  round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_timestamp))) / 6e7, 9)
    AS lag_minutes,
  max(event_timestamp) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 MINUTES AS is_stale
FROM e""")
oracle("dq_volume", "SELECT * FROM volume", VOLUME)
oracle("dq_scorecard", """
SELECT round(sum(rows_checked - violations) FILTER (rule LIKE '% present') * 100.0E0
             / sum(rows_checked) FILTER (rule LIKE '% present'), 9) AS completeness_percent,
  round(sum(rows_checked - violations) * 100.0E0 / sum(rows_checked), 9) AS accuracy_percent,
  (SELECT round(avg(CAST(within_tolerance AS INTEGER)) * 100.0E0, 9) FROM volume)
    AS steady_hours_percent
FROM checks""", CHECKS, VOLUME)
NULL_COLUMNS = """event_id source_type event_type event_timestamp user_id profile_id device_id
  session_id content_id content_type title position_ms duration_ms device_type os_name os_version
  country region seek_from_ms seek_to_ms old_quality new_quality new_bitrate automatic
  current_bitrate bitrate_kbps bandwidth_estimate rebuffer_duration_ms total_watch_time_ms
  completion_percentage end_reason""".split()
oracle("dq_null_rates", "\nUNION ALL ".join(
    "SELECT 'source_type' AS column_name, 0.0E0 AS null_rate" if _c == "source_type" else
    f"SELECT '{_c}' AS column_name, round(1 - count({_c}) / CAST(count(*) AS DOUBLE), 9) "
    "AS null_rate FROM e" for _c in NULL_COLUMNS))
