"""Live state per aircraft."""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from contrail.operators import clean
from contrail.operators.geo import with_distance
from contrail.operators.tracks import TRAIL_POINTS, TREND_METRES
from contrail.schema import RADAR_CENTRE

# The handler travels to the executors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: silence that ends a track.
SILENCE_SECONDS = 45

# Order of a report's fields in the state.
REPORT = [
    "time_position", "latitude", "longitude", "baro_altitude", "velocity", "true_track", "callsign",
    "origin_country", "squawk",
]

_POINTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("time_position", T.LongType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
        ]
    )
)

# Aircraft are dealt to so many groups by a hash of their address; a group's tracks are one value of the state.
GROUPS = 1024

# A list of [icao24, version, expiry, reports] as JSON; a track that has ended has neither expiry nor reports.
_STATE = T.StructType([T.StructField("tracks", T.StringType()), T.StructField("due", T.LongType())])

LIVE = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("time_position", T.LongType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("trend", T.StringType()),
        T.StructField("trail", _POINTS),
    ]
)


def _rank(row: tuple) -> tuple:
    """A total order of reports; unknown values come first."""
    return tuple((value is not None, value) for value in row)


def newest(held: dict[int, tuple], rows: Iterable[tuple] | pd.DataFrame, n: int) -> dict[int, tuple]:
    """The last `n` distinct seconds of `held` and `rows`, oldest first.

    `rows` are tuples in the order of `REPORT`, or a frame with those columns; no more than a few times `n` of them
    are held. Of several reports of a second the highest by `_rank` counts, so arrival makes no difference.
    """
    if isinstance(rows, pd.DataFrame):
        rows = zip(*[rows[name].tolist() for name in REPORT])
    merged = dict(held)
    for row in rows:
        row = tuple([None if value != value else value for value in row])
        other = merged.get(row[0])
        if other is None or (row != other and _rank(row) > _rank(other)):
            merged[row[0]] = row
            if len(merged) > 4 * n:
                merged = {second: merged[second] for second in sorted(merged)[-n:]}
    return {second: merged[second] for second in sorted(merged)[-n:]}


def unbroken(rows: list[tuple], silence: int) -> list[tuple]:
    """The end of `rows` that has no silence in it."""
    start = len(rows) - 1
    while start > 0 and rows[start][0] - rows[start - 1][0] <= silence:
        start -= 1
    return rows[start:]


def trend(rows: list[tuple]) -> str:
    """Altitude against the report before: `up`, `down`, or `=` if alike or unknown."""
    altitudes = [row[REPORT.index("baro_altitude")] for row in rows[-2:]]
    if len(altitudes) < 2 or None in altitudes:
        return "="
    climb = altitudes[1] - altitudes[0]
    return "up" if climb > TREND_METRES else "down" if climb < -TREND_METRES else "="


class LiveTracker(StatefulProcessor):
    """Holds the newest eleven reports of each aircraft of a group: ten for the trail, one for the trend.

    Rows of a batch are cut to eleven an aircraft as they come in, so a busy aircraft needs no more
    memory than a quiet one, and their order does not matter. Every row that it hands out has its
    aircraft's next version, which outlives the track: one number an address, of which there are 2^24.
    Calls to the state cost more than an aircraft's few reports do, so they are made once a group and batch: a
    group has 1 in `GROUPS` of the addresses, and one timer, for the first of its tracks to end.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("tracks", _STATE)

    def _load(self) -> tuple[dict, int | None]:
        """({icao24: [version, expiry, reports by second]}, the time of the timer)."""
        stored = self.state.get()
        if not stored:
            return {}, None
        tracks = {}
        for icao24, version, expiry, rows in json.loads(stored[0]):
            tracks[icao24] = [version, expiry, {row[0]: tuple(row) for row in rows}]
        return tracks, stored[1]

    def _store(self, tracks: dict) -> int | None:
        """When the first of the tracks ends."""
        due = min((expiry for _, expiry, _ in tracks.values() if expiry is not None), default=None)
        whole = [[icao24, version, expiry, list(held.values())] for icao24, (version, expiry, held) in tracks.items()]
        self.state.update((json.dumps(whole), due))
        return due

    def _rows(self, tracks: dict, chosen: Iterable[str | None], status: str) -> pd.DataFrame:
        """The next version of each of the `chosen` aircraft."""
        out = []
        for icao24 in chosen:
            tracks[icao24][0] += 1
            rows = unbroken(list(tracks[icao24][2].values()), self.silence)
            row = dict(zip(REPORT, rows[-1])) | {"icao24": icao24, "status": status, "trend": trend(rows)}
            trail = [{"time_position": r[0], "latitude": r[1], "longitude": r[2]} for r in rows[-TRAIL_POINTS:]]
            out.append(row | {"version": tracks[icao24][0], "trail": trail})
        return pd.DataFrame({name: [row[name] for row in out] for name in LIVE.fieldNames()})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tracks, timer = self._load()
        touched = {}
        for chunk in rows:
            came = defaultdict(list)
            for icao24, *row in zip(*[chunk[name].tolist() for name in ("icao24", *REPORT)]):
                came[icao24].append(row)
            for icao24, some in came.items():
                track = tracks.setdefault(icao24, [0, None, {}])
                track[2] = newest(track[2], some, TRAIL_POINTS + 1)
            touched |= dict.fromkeys(came)
        for icao24 in touched:
            # What came before a silence is held too: a late report may yet fill it.
            expiry = (max(tracks[icao24][2]) + self.silence) * 1000
            tracks[icao24][1] = max(expiry, timerValues.getCurrentWatermarkInMs() + 1)
        yield self._rows(tracks, touched, "live")
        due = self._store(tracks)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tracks, _ = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        ended = [icao24 for icao24, (_, expiry, _) in tracks.items() if expiry is not None and expiry <= now]
        if ended:
            yield self._rows(tracks, ended, "expired")
            for icao24 in ended:
                tracks[icao24][1:] = [None, {}]
        due = self._store(tracks)
        if due is not None:
            self.handle.registerTimer(due)

    def close(self) -> None:
        pass


def track_live(
    stream: DataFrame,
    lateness: str = "5 seconds",
    silence: int = SILENCE_SECONDS,
    centre: tuple[float, float] = RADAR_CENTRE,
) -> DataFrame:
    """Current state of each aircraft whenever it reports, and a last row when it falls silent.

    `version` counts an aircraft's rows, so of several the highest is the newest (`current`), also
    where a late report changed the trail alone; rows of status `expired` are ended tracks (`expired`).
    Time is event time: `silence` seconds without a report end a track, and a report after
    that starts a new one. A late report takes its place in the trail. Needs the RocksDB state
    store.
    """
    timed = stream if "event_time" in stream.columns else clean.to_event_time(stream)
    placed = clean.filter_valid_coords(timed).withWatermark("event_time", lateness)
    tracked = (
        placed.select(F.pmod(F.xxhash64("icao24"), F.lit(GROUPS)).alias("group"), "icao24", "event_time", *REPORT)
        .groupBy("group")
        .transformWithStateInPandas(
            statefulProcessor=LiveTracker(silence),
            outputStructType=LIVE,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return with_distance(tracked, centre)


def current(rows: DataFrame) -> DataFrame:
    """The newest row of each aircraft, of rows that `track_live` has written; its status says if the track goes on."""
    newest = Window.partitionBy("icao24").orderBy(F.desc("version"))
    return rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def expired(rows: DataFrame) -> DataFrame:
    """The last state of every track that has ended."""
    return rows.filter(F.col("status") == "expired")
