"""Sessions of a stream as keyed state with event-time timers.

Each user has a map of open sessions, by number, and a map with one entry per session and title. The
events of a micro-batch are first summed per stretch without a gap; a stretch is then joined with the
open sessions that it touches, so out-of-order events extend, start or bridge sessions as they would
in a batch. A timer at the end of each session's gap emits it and clears its entries; state therefore
holds open sessions only.

An event later than the watermark whose session is closed opens a session of its own, which is emitted
in the same batch. For this the stream's time column does not reach the operator: Spark would drop
such events before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from playlens.functions import expr as X
from playlens.operators.ordered import interval_micros
from playlens.operators.sessions import COUNTERS, shape

_COUNTS = [name for name in COUNTERS if name != "completion_sum"]
_SESSION = ("start long, end long, opened_by string, completion_sum double, content_count long, "
            + ", ".join(f"{name} long" for name in _COUNTS))
_OUTPUT = f"user_id string, {_SESSION}"


def measures(events: DataFrame) -> DataFrame:
    """One row per event with what it adds to a session; no time column."""
    end, rebuffer_end = X.is_type("PLAYBACK_END"), X.is_type("REBUFFER_END")
    completion = F.when(end, F.col("completion_percentage"))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("long")
    value = lambda condition, name: F.coalesce(
        F.when(condition, F.col(name)), F.lit(0)).cast("long")
    return events.select(
        "user_id", F.unix_micros("event_timestamp").alias("at"), "content_id", "device_type",
        F.lit(1).cast("long").alias("total_events"),
        value(end, "total_watch_time_ms").alias("total_watch_time_ms"),
        F.coalesce(completion, F.lit(0.0)).alias("completion_sum"),
        flag(completion.isNotNull()).alias("completion_count"),
        flag(X.is_type("PLAY_START")).alias("play_start_count"),
        flag(X.is_type("PAUSE")).alias("pause_count"), flag(X.is_type("SEEK")).alias("seek_count"),
        flag(X.is_error_end()).alias("error_count"), flag(rebuffer_end).alias("rebuffer_count"),
        value(rebuffer_end, "rebuffer_duration_ms").alias("total_rebuffer_duration_ms"))


class Sessions(StatefulProcessor):
    """Open sessions of one user."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.numbers = handle.getValueState("numbers", "last long")
        self.open = handle.getMapState("open", "number long", _SESSION)
        self.titles = handle.getMapState("titles", "number long, content_id string", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True)
        open_ = {number[0]: _as_dict(row) for number, row in self.open.iterator()}
        # Of events at one moment the device that sorts first opens, a missing one before all.
        found = found.sort_values(["at", "device_type"], na_position="first", kind="stable")
        stretch = (found["at"].diff() > self.gap).cumsum()
        for _, part in found.groupby(stretch, sort=True):
            self._join(part, open_)
        yield from self._close(key, open_, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        open_ = {number[0]: _as_dict(row) for number, row in self.open.iterator()}
        yield from self._close(key, open_, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _join(self, part: pd.DataFrame, open_: dict[int, dict]) -> None:
        """Adds a stretch of events to the session it belongs to, joining those it bridges."""
        first = part.iloc[0]
        device = first["device_type"]
        new = {"start": int(first["at"]), "end": int(part["at"].iloc[-1]),
               "opened_by": None if pd.isna(device) else device,
               "completion_sum": float(part["completion_sum"].sum()), "content_count": 0}
        new |= {name: int(part[name].sum()) for name in _COUNTS}
        near = [n for n, s in open_.items()
                if new["start"] - s["end"] <= self.gap and s["start"] - new["end"] <= self.gap]
        if near:
            number = near[0]
        else:
            number = (self.numbers.get()[0] if self.numbers.exists() else 0) + 1
            self.numbers.update((number,))
        titles = set(part["content_id"].dropna())
        for other in near:
            session = open_.pop(other)
            opener = min((new, session), key=lambda s: (s["start"], s["opened_by"] is not None,
                                                        s["opened_by"] or ""))
            new |= {"start": opener["start"], "opened_by": opener["opened_by"],
                    "end": max(new["end"], session["end"])}
            new |= {name: new[name] + session[name] for name in COUNTERS}
            if other == number:
                new["content_count"] += session["content_count"]
            else:
                titles |= self._forget(other)
        for title in titles:
            if not self.titles.containsKey((number, title)):
                self.titles.updateValue((number, title), (True,))
                new["content_count"] += 1
        open_[number] = new
        self.open.updateValue((number,), tuple(new[name] for name in _NAMES))

    def _forget(self, number: int) -> set[str]:
        """Removes a session's entries; returns its titles."""
        self.open.removeKey((number,))
        own = [title for n, title in self.titles.keys() if n == number]
        for title in own:
            self.titles.removeKey((number, title))
        return set(own)

    def _close(self, key, open_: dict[int, dict], watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Emits the sessions whose gap has passed and sets timers for the others."""
        done = []
        for number, session in open_.items():
            # The first millisecond at which no event in time can reach the session.
            expires = (session["end"] + self.gap) // 1000 + 1
            if expires <= watermark_ms:
                done.append({"user_id": key[0], **session})
                self._forget(number)
            else:
                self.handle.registerTimer(expires)
        if done:
            yield pd.DataFrame(done, columns=["user_id", *_NAMES])


_NAMES = [part.split()[0] for part in _SESSION.split(", ")]


def _as_dict(row) -> dict:
    return dict(zip(_NAMES, row, strict=True))


def user_sessions_state(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a watermarked stream, emitted once no event in time can reach them.

    Needs append mode and the RocksDB state store.
    """
    per_session = measures(events).groupBy("user_id").transformWithStateInPandas(
        Sessions(interval_micros(gap)), outputStructType=_OUTPUT, outputMode="Append",
        timeMode="EventTime")
    return shape(per_session.select(
        "user_id", F.timestamp_micros("start").alias("session_start"),
        F.timestamp_micros("end").alias("session_end"), F.col("opened_by").alias("device_type"),
        "content_count", *COUNTERS))
