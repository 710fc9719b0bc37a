"""Schemas and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# One position report as it arrives on the wire: epoch seconds, flat, row-oriented.
MESSAGE = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("time_position", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("squawk", T.StringType()),
    ]
)

# The table the marts are built from. `event_time` is `time_position` as a timestamp.
SILVER = T.StructType(
    MESSAGE.fields
    + [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("partition_date", T.DateType()),
    ]
)

# The ten columns of the reporting table.
GOLD_COLUMNS = [
    "icao24",
    "callsign",
    "origin_country",
    "event_time",
    "longitude",
    "latitude",
    "baro_altitude",
    "velocity",
    "processed_at",
    "partition_date",
]

REQUIRED = ["icao24", "origin_country", "time_position", "longitude", "latitude"]

# Position of each field in a snapshot's state array.
STATE_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "velocity": 9,
    "true_track": 10,
    "squawk": 14,
}

# Validation limits.
MAX_VELOCITY = 500.0
FUTURE_SECONDS = 3600
PAST_SECONDS = 365 * 24 * 3600
MIN_STATE_FIELDS = 10

# Boxes as (min lat, max lat, min lon, max lon), and the radar centre.
COUNTRY_BOX = (6.0, 38.0, 68.0, 97.0)
LOCAL_BOX = (18.30, 27.30, 81.70, 90.70)
RADAR_CENTRE = (22.8046, 86.2029)

# Known places in match order (name, latitude, longitude).
PLACES = [
    ("DEL (Delhi)", 28.556, 77.100),
    ("BOM (Mumbai)", 19.089, 72.868),
    ("BLR (Bangalore)", 13.199, 77.706),
    ("MAA (Chennai)", 12.990, 80.169),
    ("CCU (Kolkata)", 22.654, 88.447),
    ("HYD (Hyderabad)", 17.231, 78.430),
    ("GOI (Goa)", 15.381, 73.831),
    ("COK (Kochi)", 10.152, 76.402),
]

EARTH_KM = 6371.0
EMERGENCY_SQUAWK = "7700"
