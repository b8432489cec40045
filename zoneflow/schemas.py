"""Explicit schemas of every table the package reads or writes."""

from pyspark.sql import types as T

# Raw taxi trip file: every column is read as a string, casts happen in ``operators.trips``.
TAXI_RAW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge",
]
TAXI_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in TAXI_RAW_COLUMNS])

# Raw bike trip file, also all strings.
BIKE_RAW_COLUMNS = [
    "tripduration", "starttime", "stoptime", "start station id", "start station name",
    "start station latitude", "start station longitude", "end station id", "end station name",
    "end station latitude", "end station longitude", "bikeid", "usertype", "birth year", "gender",
]
BIKE_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in BIKE_RAW_COLUMNS])

# Canonical trip: the columns every trip source is reduced to.
TRIP = T.StructType([
    T.StructField("pickup", T.TimestampNTZType(), True),
    T.StructField("dropoff", T.TimestampNTZType(), True),
    T.StructField("pu_zone", T.LongType(), True),
    T.StructField("do_zone", T.LongType(), True),
])

ZONES = T.StructType([
    T.StructField("zone_id", T.LongType(), False),
    T.StructField("graph_id", T.LongType(), False),
    T.StructField("zone_name", T.StringType(), True),
])

POINT = T.StructType([T.StructField("x", T.DoubleType(), False), T.StructField("y", T.DoubleType(), False)])
ZONE_SHAPES = T.StructType([
    T.StructField("zone_id", T.LongType(), False),
    T.StructField("ring", T.ArrayType(POINT, False), False),
])

EDGES = T.StructType([
    T.StructField("src", T.LongType(), False),
    T.StructField("dst", T.LongType(), False),
    T.StructField("w", T.DoubleType(), False),
])

# Flow event as it travels through the log: JSON ``{"region_id": .., "time": ".."}``.
FLOW_EVENT_JSON = T.StructType([
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("region_id", T.LongType(), True),
])

FLOW_EVENT = T.StructType([
    T.StructField("flow_type", T.StringType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("region_id", T.LongType(), True),
])

FLOW_WINDOW = T.StructType([
    T.StructField("interval_start", T.TimestampNTZType(), False),
    T.StructField("flow_type", T.StringType(), False),
    T.StructField("zone_id", T.LongType(), True),
    T.StructField("flow", T.LongType(), False),
])

# Wide bike stream row (both ends with coordinates and zones).
BIKE_STREAM = T.StructType([
    T.StructField("starttime", T.TimestampNTZType(), True),
    T.StructField("stoptime", T.TimestampNTZType(), True),
    T.StructField("start station latitude", T.DoubleType(), True),
    T.StructField("start station longitude", T.DoubleType(), True),
    T.StructField("end station latitude", T.DoubleType(), True),
    T.StructField("end station longitude", T.DoubleType(), True),
    T.StructField("PULocationID", T.LongType(), True),
    T.StructField("DOLocationID", T.LongType(), True),
])
