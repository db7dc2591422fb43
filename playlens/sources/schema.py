"""The event model: nested record as it arrives, flat row as it is analysed."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, device types, qualities, end reasons.
EVENT_TYPES = (
    "PLAY_START", "PAUSE", "RESUME", "SEEK", "PROGRESS", "QUALITY_CHANGE",
    "REBUFFER_START", "REBUFFER_END", "PLAYBACK_END",
)
DEVICE_TYPES = ("IOS", "ANDROID", "WEB", "SMART_TV", "GAMING_CONSOLE", "SET_TOP_BOX")
VIDEO_QUALITIES = ("AUTO", "SD_480P", "HD_720P", "HD_1080P", "UHD_4K", "UHD_8K")
END_REASONS = (
    "COMPLETED", "USER_STOPPED", "USER_EXIT", "ERROR", "NETWORK_ERROR", "APP_TERMINATED",
)
ERROR_REASONS = ("ERROR", "NETWORK_ERROR")

# Thresholds. The 5-minute metrics call a view complete at 90 %,
# the continue-watching list shows titles between 2 % and 95 %.
COMPLETED_PERCENT = 90.0
CONTINUE_MIN_PERCENT = 2.0
CONTINUE_MAX_PERCENT = 95.0
DEFAULT_EVENT_LIMIT = 100
DEFAULT_CONTINUE_LIMIT = 20

# Retention in days; tables not named are kept.
RETENTION_DAYS = {
    "events_by_user": 90,
    "events_by_session": 7,
    "events_by_content": 30,
    "playback_quality_events": 7,
    "content_metrics_5min": 7,
    "user_sessions": 90,
}

# Primary key and time column of the hot tables. A row written
# again with the same key replaces the earlier one.
TABLE_KEYS = {
    "events_by_user": (("user_id", "timestamp", "event_id"), "timestamp"),
    "events_by_session": (("session_id", "timestamp", "event_id"), "timestamp"),
    "events_by_content": (("content_id", "timestamp", "user_id", "event_id"), "timestamp"),
    "user_content_progress": (("user_id", "content_id"), "last_watched"),
    "continue_watching": (("user_id", "last_watched", "content_id"), "last_watched"),
    "playback_quality_events": (("content_id", "event_date", "timestamp", "event_id"),
                                "timestamp"),
    "content_metrics_5min": (("content_id", "window_start"), "window_start"),
    "user_sessions": (("user_id", "session_start", "session_id"), "session_start"),
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _I, _D, _B = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                      T.BooleanType())

DEVICE_INFO = _struct(deviceType=_S, deviceId=_S, deviceModel=_S, osName=_S, osVersion=_S,
                      appVersion=_S, ipAddress=_S, country=_S, region=_S, city=_S)

# The five payload records, in the order of the wire format's union.
PAYLOAD = _struct(
    seek=_struct(fromPosition=_L, toPosition=_L),
    qualityChange=_struct(oldQuality=_S, newQuality=_S, oldBitrate=_I, newBitrate=_I,
                          reason=_S, automatic=_B),
    rebuffer=_struct(bufferLength=_L, rebufferDuration=_L, bandwidthEstimate=_I,
                     networkType=_S),
    playbackEnd=_struct(reason=_S, finalPosition=_L, totalWatchTime=_L,
                        completionPercentage=_D, errorCode=_S, errorMessage=_S),
    progress=_struct(bufferLength=_L, currentQuality=_S, currentBitrate=_I, droppedFrames=_I,
                     playbackRate=_D, audioLanguage=_S, subtitleLanguage=_S,
                     subtitlesEnabled=_B),
)

# `timestamp` is epoch milliseconds on the wire.
RAW_EVENT = _struct(eventId=_S, eventType=_S, timestamp=_L, userId=_S, profileId=_S,
                    deviceId=_S, sessionId=_S, contentId=_S, contentType=_S, title=_S,
                    position=_L, duration=_L, deviceInfo=DEVICE_INFO, payload=PAYLOAD)

REQUIRED_FIELDS = ("eventId", "eventType", "timestamp", "userId", "deviceId", "sessionId",
                   "contentId")

# The flat event row every operator takes.
FLAT_EVENT = T.StructType([
    T.StructField(name, kind) for name, kind in (
        ("event_id", _S), ("event_type", _S), ("event_timestamp", T.TimestampType()),
        ("user_id", _S), ("profile_id", _S), ("device_id", _S), ("session_id", _S),
        ("content_id", _S), ("content_type", _S), ("title", _S),
        ("position_ms", _L), ("duration_ms", _L),
        ("device_type", _S), ("os_name", _S), ("os_version", _S), ("country", _S),
        ("region", _S),
        ("seek_from_ms", _L), ("seek_to_ms", _L),
        ("old_quality", _S), ("new_quality", _S), ("new_bitrate", _L), ("automatic", _B),
        ("current_bitrate", _L), ("bitrate_kbps", _L), ("bandwidth_estimate", _L),
        ("rebuffer_duration_ms", _L),
        ("total_watch_time_ms", _L), ("completion_percentage", _D), ("end_reason", _S),
        ("payload_json", _S),
    )
])

# Stored history row: 18 columns plus the four the reports filter and average on.
HISTORY_COLUMNS = (
    "event_id", "event_type", "event_timestamp", "user_id", "profile_id", "device_id",
    "session_id", "content_id", "content_type", "title", "position_ms", "duration_ms",
    "device_type", "os_name", "os_version", "country", "region", "payload_json",
)
HISTORY_DERIVED = ("event_date", "event_hour", "bitrate_kbps", "rebuffer_duration_ms")
