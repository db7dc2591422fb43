"""The wire format as Avro schema text, and the checks that follow from such a text."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.sources.schema import (DEVICE_TYPES, END_REASONS, EVENT_TYPES, PAYLOAD, RAW_EVENT,
                                     REQUIRED_FIELDS, VIDEO_QUALITIES)

# Fields of enumerated type, and fields of the nested records that must be there.
ENUMS = {"eventType": ("EventType", EVENT_TYPES), "deviceType": ("DeviceType", DEVICE_TYPES),
         "oldQuality": ("VideoQuality", VIDEO_QUALITIES),
         "newQuality": ("VideoQuality", VIDEO_QUALITIES),
         "currentQuality": ("VideoQuality", VIDEO_QUALITIES),
         "playbackEnd.reason": ("PlaybackEndReason", END_REASONS)}
REQUIRED_NESTED = {
    "deviceInfo": ("deviceType",),
    "seek": ("fromPosition", "toPosition"),
    "qualityChange": ("oldQuality", "newQuality", "oldBitrate", "newBitrate"),
    "rebuffer": ("bufferLength", "bandwidthEstimate"),
    "playbackEnd": ("reason", "finalPosition", "totalWatchTime", "completionPercentage"),
    "progress": ("bufferLength", "currentQuality", "currentBitrate"),
}

_PRIMITIVES = {"string": "string", "bigint": "long", "int": "int", "double": "double",
               "boolean": "boolean"}


def avro_schema() -> str:
    """Avro schema text of the event model."""
    defined: set[str] = set()

    def type_of(record: str, field: T.StructField):
        name, symbols = ENUMS.get(f"{record}.{field.name}", ENUMS.get(field.name, ("", ())))
        if name:
            known = name in defined
            defined.add(name)
            return name if known else {"type": "enum", "name": name, "symbols": list(symbols)}
        if isinstance(field.dataType, T.StructType):
            return record_of(field.name, field.dataType)
        if (record, field.name) == ("event", "timestamp"):
            return {"type": "long", "logicalType": "timestamp-millis"}
        return _PRIMITIVES[field.dataType.simpleString()]

    def record_of(name: str, schema: T.StructType, required: tuple[str, ...] | None = None) -> dict:
        required = REQUIRED_NESTED.get(name, ()) if required is None else required
        fields = []
        for field in schema.fields:
            if field.name == "payload":
                kinds = [record_of(member.name, member.dataType) for member in PAYLOAD.fields]
            else:
                kinds = [type_of(name, field)]
            fields.append({"name": field.name, "type": kinds[0]} if field.name in required else
                          {"name": field.name, "type": ["null", *kinds], "default": None})
        return {"type": "record", "name": name, "fields": fields}

    return json.dumps(record_of("event", RAW_EVENT, REQUIRED_FIELDS))


def checks_of(schema_text: str, root: str = "event", optional: tuple[str, ...] = ()
              ) -> list[tuple[str, Column]]:
    """Reasons and conditions of bad records, in the order of the schema's fields.

    A field without null in its type and without a default must be there, wherever its record is;
    a value of an enumeration must be one of its symbols. Members of a union of records are told
    apart as the fields of `PAYLOAD`, in order. Fields in `optional` may be missing.
    """
    named: dict[str, dict] = {}

    def define(kind) -> None:
        """Collects the named types, which may be used before or after they are spelt out."""
        if isinstance(kind, list):
            for member in kind:
                define(member)
        elif isinstance(kind, dict):
            if "name" in kind:
                named[kind["name"].rsplit(".", 1)[-1]] = kind
            for field in kind.get("fields", []):
                define(field["type"])
            for inner in (kind.get("items"), kind.get("values")):
                define(inner)

    def resolved(kind) -> dict:
        if isinstance(kind, dict):
            return resolved(kind["type"]) if isinstance(kind["type"], (dict, list)) else kind
        return named.get(kind.rsplit(".", 1)[-1], {"type": kind})

    def walk(record: dict, path: str, present: Column | None) -> Iterator[tuple[str, Column]]:
        for field in record["fields"]:
            kinds = field["type"] if isinstance(field["type"], list) else [field["type"]]
            members = [resolved(kind) for kind in kinds if kind != "null"]
            name = f"{path}{field['name']}"
            value = F.col(f"{root}.{name}")
            if "null" not in kinds and "default" not in field and name not in optional:
                absent = value.isNull()
                yield f"missing {name}", absent if present is None else present & absent
            for number, member in enumerate(members):
                if member["type"] == "enum":
                    yield f"unknown {name}", value.isNotNull() & ~value.isin(*member["symbols"])
                elif member["type"] == "record":
                    inner = f"{name}.{PAYLOAD.fields[number].name}" if len(members) > 1 else name
                    yield from walk(member, f"{inner}.", F.col(f"{root}.{inner}").isNotNull())

    schema = json.loads(schema_text)
    define(schema)
    return list(walk(schema, "", None))
