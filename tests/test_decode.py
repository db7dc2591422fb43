"""Decoding, quarantine and the history round trip."""

import json

import pytest
from events import at, make_events, rows_of
from pyspark.sql import functions as F

from playlens.operators import views
from playlens.plans.layout import events_from_history
from playlens.sources import decode
from playlens.sources.wire import checks_of
from playlens.sources.schema import EVENT_TYPES, FLAT_EVENT
from playlens.streaming.sources import RAW_RECORD

CORE = {"eventId": "e1", "eventType": "SEEK", "timestamp": 1704067200123, "userId": "u1",
        "deviceId": "d1", "sessionId": "s1", "contentId": "c1", "position": 30000,
        "duration": 7200000}
BROKER_TIME = at("2024-02-02 03:04:05")


def decoded(spark, *values):
    raw = spark.createDataFrame([(v, BROKER_TIME) for v in values], RAW_RECORD)
    return decode.decode_events(raw)


def one(spark, **changes):
    value = json.dumps({k: v for k, v in {**CORE, **changes}.items() if v is not ...})
    return rows_of(decode.accepted(decoded(spark, value)))


def test_seek_payload_and_device(spark):
    row, = one(spark, deviceInfo={"deviceType": "IOS", "deviceModel": "iPhone 15 Pro"},
               payload={"seek": {"fromPosition": 10000, "toPosition": 30000}})
    assert (row["seek_from_ms"], row["seek_to_ms"]) == (10000, 30000)
    assert (row["position_ms"], row["duration_ms"]) == (30000, 7200000)
    assert row["device_type"] == "IOS"
    assert json.loads(row["payload_json"]) == {"fromPosition": 10000, "toPosition": 30000}


def test_quality_change_payload(spark):
    row, = one(spark, eventType="QUALITY_CHANGE", payload={"qualityChange": {
        "oldQuality": "HD_720P", "newQuality": "HD_1080P", "oldBitrate": 3000,
        "newBitrate": 5000, "automatic": True}})
    assert (row["old_quality"], row["new_quality"]) == ("HD_720P", "HD_1080P")
    assert (row["new_bitrate"], row["bitrate_kbps"], row["automatic"]) == (5000, 5000, True)


def test_progress_payload(spark):
    row, = one(spark, eventType="PROGRESS", payload={"progress": {
        "bufferLength": 1, "currentQuality": "UHD_4K", "currentBitrate": 15000,
        "droppedFrames": 2, "subtitleLanguage": "en", "subtitlesEnabled": True}})
    assert row["bitrate_kbps"] == row["current_bitrate"] == 15000
    assert json.loads(row["payload_json"])["droppedFrames"] == 2


def test_playback_end_payload(spark):
    row, = one(spark, eventType="PLAYBACK_END", payload={"playbackEnd": {
        "reason": "COMPLETED", "finalPosition": 7200000, "totalWatchTime": 7150000,
        "completionPercentage": 99.3}})
    assert row["completion_percentage"] == pytest.approx(99.3, abs=0.01)
    assert (row["total_watch_time_ms"], row["end_reason"]) == (7150000, "COMPLETED")


def test_no_payload_stays_null(spark):
    row, = one(spark, eventType="PLAY_START")
    assert row["payload_json"] is None


def test_all_event_types(spark):
    values = [json.dumps({**CORE, "eventId": str(i), "eventType": t})
              for i, t in enumerate(EVENT_TYPES)]
    kept = rows_of(decode.accepted(decoded(spark, *values)))
    assert {r["event_type"] for r in kept} == set(EVENT_TYPES)


def test_timestamp_keeps_milliseconds(spark):
    value = json.dumps(CORE)
    kept = decode.accepted(decoded(spark, value))
    assert kept.select(F.unix_millis("event_timestamp")).first()[0] == 1704067200123


def test_missing_time_falls_back_to_broker(spark):
    kept = decode.accepted(decoded(spark, json.dumps({**CORE, "timestamp": None})))
    assert kept.select(F.unix_millis("event_timestamp")).first()[0] == \
        int(BROKER_TIME.timestamp() * 1000)


def test_quarantine_reasons(spark):
    frame = decoded(spark, "{not json", "", json.dumps({**CORE, "eventType": "REWIND"}),
                    json.dumps({k: v for k, v in CORE.items() if k != "userId"}),
                    json.dumps({**CORE, "position": "soon"}), json.dumps(CORE))
    bad = rows_of(decode.quarantined(frame))
    assert sorted(r["reject_reason"] for r in bad) == [
        "missing userId", "unknown eventType", "unreadable", "unreadable", "unreadable"]
    assert "{not json" in {r["raw_value"] for r in bad}
    assert decode.accepted(frame).count() == 1


END = {"reason": "COMPLETED", "finalPosition": 1, "totalWatchTime": 2, "completionPercentage": 3.0}
CHANGE = {"oldQuality": "AUTO", "newQuality": "SD_480P", "oldBitrate": 1, "newBitrate": 2}


@pytest.mark.parametrize(("fields", "reason"), [
    ({"deviceInfo": {"deviceType": "TOASTER"}}, "unknown deviceInfo.deviceType"),
    ({"deviceInfo": {"osName": "x"}}, "missing deviceInfo.deviceType"),
    ({"deviceInfo": {"deviceType": "WEB"}}, None),
    ({"payload": {"playbackEnd": {**END, "reason": "BOGUS"}}}, "unknown payload.playbackEnd.reason"),
    ({"payload": {"playbackEnd": {k: v for k, v in END.items() if k != "completionPercentage"}}},
     "missing payload.playbackEnd.completionPercentage"),
    ({"payload": {"playbackEnd": END}}, None),
    ({"payload": {"qualityChange": {**CHANGE, "newQuality": "SHARP"}}},
     "unknown payload.qualityChange.newQuality"),
    ({"payload": {"qualityChange": CHANGE}}, None),
    ({"payload": {"seek": {"fromPosition": 1}}}, "missing payload.seek.toPosition"),
    ({"payload": {"rebuffer": {"bufferLength": 1}}}, "missing payload.rebuffer.bandwidthEstimate"),
    ({"payload": {"progress": {"bufferLength": 1, "currentQuality": "8K", "currentBitrate": 2}}},
     "unknown payload.progress.currentQuality"),
    ({"payload": None}, None), ({"payload": {}}, None), ({"timestamp": None}, None),
    ({"userId": None, "deviceInfo": {"deviceType": "TOASTER"}}, "missing userId"),
    ({"eventType": "REWIND", "payload": {"seek": {}}}, "unknown eventType"),
])
def test_records_are_checked_against_the_wire_schema(spark, fields, reason):
    row = decoded(spark, json.dumps({**CORE, **fields})).first()
    assert row["reject_reason"] == reason


def test_checks_follow_a_given_schema_text(spark):
    """Named types used before they are defined, name spaces, defaults, unions of records."""
    kind = {"type": "enum", "name": "Kind", "symbols": ["PLAY_START", "SEEK"]}
    schema = {"type": "record", "name": "Event", "namespace": "x.y", "fields": [
        {"name": "eventId", "type": "string"}, {"name": "eventType", "type": "x.y.Kind"},
        {"name": "contentType", "type": ["null", kind], "default": None},
        {"name": "title", "type": "string", "default": "-"},
        {"name": "payload", "type": ["null", {"type": "record", "name": "A", "fields": [
            {"name": "toPosition", "type": "long"}]}, {"type": "record", "name": "B", "fields": [
                {"name": "oldQuality", "type": "Kind"}]}], "default": None}]}
    names = [name for name, _ in checks_of(json.dumps(schema))]
    assert names == ["missing eventId", "missing eventType", "unknown eventType",
                     "unknown contentType", "missing payload.seek.toPosition",
                     "missing payload.qualityChange.oldQuality",
                     "unknown payload.qualityChange.oldQuality"]
    rows = [{**CORE, "eventType": "PAUSE"}, {**CORE, "eventType": "SEEK", "userId": None},
            {**CORE, "eventType": "SEEK", "payload": {"qualityChange": {"oldQuality": "AUTO"}}}]
    raw = spark.createDataFrame([(json.dumps(r).encode(), BROKER_TIME) for r in rows],
                                "value binary, timestamp timestamp")
    found = decode.decode_events(raw, "json", json.dumps(schema)).collect()
    assert [r["reject_reason"] for r in found] == [
        "unknown eventType", None, "unknown payload.qualityChange.oldQuality"]


def test_null_value_is_quarantined(spark):
    assert [r["reject_reason"] for r in rows_of(decode.quarantined(decoded(spark, None)))] == [
        "unreadable"]


def test_avro_needs_a_schema(spark):
    raw = spark.createDataFrame([(b"", BROKER_TIME)], "value binary, timestamp timestamp")
    with pytest.raises(ValueError):
        decode.decode_events(raw, "avro")
    with pytest.raises(ValueError):
        decode.decode_events(raw, "xml")


def test_history_replays_to_the_same_events(spark):
    from checks.registry import with_payload_json
    from conftest import SMALL
    from playlens.sources.tables import playback_events

    flat = with_payload_json(playback_events(spark, SMALL)).select(*FLAT_EVENT.fieldNames())
    replayed = events_from_history(views.history_events(flat))
    assert replayed.columns == flat.columns
    assert flat.exceptAll(replayed).count() == 0 and replayed.count() == flat.count()


def test_parse_happens_once(spark):
    frame = decode.quarantined(decoded(spark, json.dumps(CORE)))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_schema_evolution_gives_null_for_new_columns(spark, scratch):
    from playlens.plans.layout import read_history

    make_events(spark, [{"event_timestamp": "10:00:00"}]).select(
        "event_id", "event_type", "event_timestamp").write.parquet(f"{scratch}/old")
    row = read_history(spark, f"{scratch}/old").first()
    assert row["event_id"] == "e0000" and row["region"] is None
