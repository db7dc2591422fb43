"""Turning raw broker records into typed events, and setting bad ones aside.

`raw` has the columns a Kafka source gives: `value` (binary or string) and
`timestamp` (broker time). The result keeps every row; `reject_reason` is null
for good rows, so one parse feeds both the event stream and the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.sources.schema import PAYLOAD, RAW_EVENT
from playlens.sources.wire import avro_schema as own_schema
from playlens.sources.wire import checks_of

# Fixed value: a registry-framed Avro message starts with a magic byte and a
# four-byte schema id.
REGISTRY_HEADER_BYTES = 5

WIRE_SCHEMA = own_schema()

_JSON_SCHEMA = T.StructType(RAW_EVENT.fields + [T.StructField("_corrupt", T.StringType())])


def decode_events(raw: DataFrame, fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """Adds `event` (nested, null when unreadable) and `reject_reason`.

    Records are checked against the Avro schema text, that of the event model if none is given.
    """
    if fmt == "json":
        parsed = F.from_json(F.col("value").cast("string"), _JSON_SCHEMA,
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        unreadable = F.col("event").isNull() | F.col("event._corrupt").isNotNull()
    elif fmt == "avro":
        parsed = _avro_event(avro_schema)
        unreadable = F.col("event").isNull()
    else:
        raise ValueError(f"unknown wire format: {fmt}")
    # As a generator the parse is evaluated once per row: a filter on its result
    # cannot be pushed below it, which would repeat the parse in every condition.
    with_event = raw.select("*", F.explode(F.array(parsed)).alias("event"))
    return with_event.withColumn("reject_reason",
                                 _reject_reason(unreadable, avro_schema or WIRE_SCHEMA))


def _reject_reason(unreadable: Column, schema_text: str) -> Column:
    """One reason per row: unreadable, then what the wire schema asks for, top-level fields first."""
    reason = F.when(unreadable, "unreadable")
    # The broker's time stands in for a missing one.
    checks = checks_of(schema_text, optional=("timestamp",))
    for name, broken in sorted(checks, key=lambda check: "." in check[0]):
        reason = reason.when(broken, name)
    return reason


def _avro_event(avro_schema: str | None) -> Column:
    """Needs the Avro package on the classpath and the registry's schema text."""
    from pyspark.sql.avro.functions import from_avro

    if not avro_schema:
        raise ValueError("fmt='avro' needs avro_schema")
    start = REGISTRY_HEADER_BYTES + 1
    body = F.substring("value", start, 2_147_483_647)
    record = from_avro(body, avro_schema, {"mode": "PERMISSIVE"})
    # A union of records arrives as a struct of members, in union order.
    members = [record["payload"][f"member{i}"].cast(field.dataType).alias(field.name)
               for i, field in enumerate(PAYLOAD.fields)]
    columns = []
    for field in RAW_EVENT.fields:
        if field.name == "payload":
            columns.append(F.when(record["payload"].isNotNull(), F.struct(*members))
                            .alias("payload"))
        elif field.name == "timestamp":
            # timestamp-millis arrives as a timestamp
            columns.append(F.unix_millis(record["timestamp"]).alias("timestamp"))
        else:
            columns.append(record[field.name].cast(field.dataType).alias(field.name))
    return F.when(record.isNotNull(), F.struct(*columns))


def accepted(decoded: DataFrame) -> DataFrame:
    """Flat events of the good rows."""
    return flatten_events(decoded.filter(F.col("reject_reason").isNull()), "timestamp")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Bad rows with the reason and the value as it came."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", F.col("value").cast("string").alias("raw_value"),
        F.col("timestamp").alias("received_at"))


def payload_json(payload: str = "event.payload") -> Column:
    """The one payload record that is set, as JSON text."""
    return F.coalesce(*[
        F.when(F.col(f"{payload}.{field.name}").isNotNull(),
               F.to_json(F.col(f"{payload}.{field.name}")))
        for field in PAYLOAD.fields])


def flatten_events(decoded: DataFrame, broker_time: str | None = None) -> DataFrame:
    """Nested `event` to the flat row; event time falls back to the broker's."""
    event_time = F.timestamp_millis(F.col("event.timestamp"))
    if broker_time:
        event_time = F.coalesce(event_time, F.col(broker_time).cast("timestamp"))
    new_bitrate = F.col("event.payload.qualityChange.newBitrate").cast("bigint")
    current_bitrate = F.col("event.payload.progress.currentBitrate").cast("bigint")
    return decoded.select(
        F.col("event.eventId").alias("event_id"),
        F.col("event.eventType").alias("event_type"),
        event_time.alias("event_timestamp"),
        F.col("event.userId").alias("user_id"),
        F.col("event.profileId").alias("profile_id"),
        F.col("event.deviceId").alias("device_id"),
        F.col("event.sessionId").alias("session_id"),
        F.col("event.contentId").alias("content_id"),
        F.col("event.contentType").alias("content_type"),
        F.col("event.title").alias("title"),
        F.col("event.position").alias("position_ms"),
        F.col("event.duration").alias("duration_ms"),
        F.col("event.deviceInfo.deviceType").alias("device_type"),
        F.col("event.deviceInfo.osName").alias("os_name"),
        F.col("event.deviceInfo.osVersion").alias("os_version"),
        F.col("event.deviceInfo.country").alias("country"),
        F.col("event.deviceInfo.region").alias("region"),
        F.col("event.payload.seek.fromPosition").alias("seek_from_ms"),
        F.col("event.payload.seek.toPosition").alias("seek_to_ms"),
        F.col("event.payload.qualityChange.oldQuality").alias("old_quality"),
        F.col("event.payload.qualityChange.newQuality").alias("new_quality"),
        new_bitrate.alias("new_bitrate"),
        F.col("event.payload.qualityChange.automatic").alias("automatic"),
        current_bitrate.alias("current_bitrate"),
        F.coalesce(new_bitrate, current_bitrate).alias("bitrate_kbps"),
        F.col("event.payload.rebuffer.bandwidthEstimate").cast("bigint")
         .alias("bandwidth_estimate"),
        F.col("event.payload.rebuffer.rebufferDuration").alias("rebuffer_duration_ms"),
        F.col("event.payload.playbackEnd.totalWatchTime").alias("total_watch_time_ms"),
        F.col("event.payload.playbackEnd.completionPercentage").alias("completion_percentage"),
        F.col("event.payload.playbackEnd.reason").alias("end_reason"),
        payload_json().alias("payload_json"),
    )


def nest_events(flat: DataFrame, *keep: str) -> DataFrame:
    """Flat row back to the nested wire record, as column `event`; `keep` stays beside it.

    Used to replay a history through the decoder; payload fields the flat row
    does not carry are null unless there are columns `buffer_length`, `old_bitrate` and
    `current_quality` for them.
    """
    extra = {name: F.col(name) if name in flat.columns else F.lit(None)
             for name in ("buffer_length", "old_bitrate", "current_quality")}

    def struct_of(schema: T.StructType, known: dict[str, Column]) -> Column:
        return F.struct(*[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields])

    def branch(name: str, event_types: tuple[str, ...], known: dict[str, Column]) -> Column:
        schema = PAYLOAD[name].dataType
        return F.when(F.col("event_type").isin(*event_types),
                      struct_of(schema, known)).alias(name)

    payload = F.struct(
        branch("seek", ("SEEK",), {
            "fromPosition": F.col("seek_from_ms"), "toPosition": F.col("seek_to_ms")}),
        branch("qualityChange", ("QUALITY_CHANGE",), {
            "oldQuality": F.col("old_quality"), "newQuality": F.col("new_quality"),
            "oldBitrate": extra["old_bitrate"],
            "newBitrate": F.col("new_bitrate"), "automatic": F.col("automatic")}),
        branch("rebuffer", ("REBUFFER_START", "REBUFFER_END"), {
            "bufferLength": extra["buffer_length"],
            "rebufferDuration": F.col("rebuffer_duration_ms"),
            "bandwidthEstimate": F.col("bandwidth_estimate")}),
        branch("playbackEnd", ("PLAYBACK_END",), {
            "reason": F.col("end_reason"), "finalPosition": F.col("position_ms"),
            "totalWatchTime": F.col("total_watch_time_ms"),
            "completionPercentage": F.col("completion_percentage")}),
        branch("progress", ("PROGRESS",), {
            "bufferLength": extra["buffer_length"], "currentQuality": extra["current_quality"],
            "currentBitrate": F.col("current_bitrate")}),
    )
    has_payload = F.col("event_type").isin(
        "SEEK", "QUALITY_CHANGE", "REBUFFER_START", "REBUFFER_END", "PLAYBACK_END", "PROGRESS")
    device = {"deviceType": F.col("device_type"), "deviceId": F.col("device_id"),
              "osName": F.col("os_name"), "osVersion": F.col("os_version"),
              "country": F.col("country"), "region": F.col("region")}
    has_device = F.col("device_type").isNotNull()
    fields = {
        "eventId": F.col("event_id"), "eventType": F.col("event_type"),
        "timestamp": F.unix_millis("event_timestamp"), "userId": F.col("user_id"),
        "profileId": F.col("profile_id"), "deviceId": F.col("device_id"),
        "sessionId": F.col("session_id"), "contentId": F.col("content_id"),
        "contentType": F.col("content_type"), "title": F.col("title"),
        "position": F.col("position_ms"), "duration": F.col("duration_ms"),
        "deviceInfo": F.when(has_device, struct_of(RAW_EVENT["deviceInfo"].dataType, device)),
        "payload": F.when(has_payload, payload),
    }
    return flat.select(*keep, F.struct(*[fields[f.name].alias(f.name)
                                         for f in RAW_EVENT.fields]).alias("event"))
