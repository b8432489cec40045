"""Trip preparation: column selection, casts, time range, area membership, history/live split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def as_timestamp(col: str, dtype: T.DataType) -> Column:
    """String -> TIMESTAMP_NTZ with ``try_cast`` (bad value -> null); typed columns pass."""
    c = F.col(col)
    if isinstance(dtype, T.StringType):
        return F.expr(f"try_cast(`{col}` as timestamp_ntz)")
    if isinstance(dtype, T.TimestampType):
        return c.cast("timestamp_ntz")
    return c if isinstance(dtype, T.TimestampNTZType) else c.cast("timestamp_ntz")


def as_long(col: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.expr(f"try_cast(`{col}` as bigint)")
    return F.col(col).cast("long")


def taxi_trips(raw: DataFrame) -> DataFrame:
    """Raw taxi file -> canonical trips (keeps only the four used columns)."""
    return raw.select(F.col("tpep_pickup_datetime").alias("pickup"), F.col("tpep_dropoff_datetime").alias("dropoff"),
                      F.col("PULocationID").alias("pu_zone"), F.col("DOLocationID").alias("do_zone"))


def bike_trips(assigned: DataFrame) -> DataFrame:
    """Bike trips with zones at both ends -> canonical trips (start = pickup, stop = dropoff)."""
    return assigned.select(F.col("starttime").alias("pickup"), F.col("stoptime").alias("dropoff"), "pu_zone", "do_zone")


def typed_trips(trips: DataFrame) -> DataFrame:
    """Casts of the canonical trip columns; unparsable values become null."""
    d = {f.name: f.dataType for f in trips.schema.fields}
    return trips.select(as_timestamp("pickup", d["pickup"]).alias("pickup"),
                        as_timestamp("dropoff", d["dropoff"]).alias("dropoff"),
                        as_long("pu_zone", d["pu_zone"]).alias("pu_zone"),
                        as_long("do_zone", d["do_zone"]).alias("do_zone"))


def in_range(col: Column, lo: str, hi: str, strict: bool = False) -> Column:
    """``lo <= col < hi`` (half-open) or, with ``strict``, ``lo < col < hi``."""
    lo_c = F.lit(lo).cast("timestamp_ntz")
    hi_c = F.lit(hi).cast("timestamp_ntz")
    return ((col > lo_c) if strict else (col >= lo_c)) & (col < hi_c)


def trips_in_area(trips: DataFrame, area: DataFrame) -> DataFrame:
    """Trips with both ends in the area (a trip leaving it is dropped entirely).

    Written as ``IN (subquery)`` predicates rather than joins on the finished trips:
    Catalyst pushes a predicate down to the table each zone column comes from and only
    then turns it into a left-semi join there, so when trips are themselves a join of
    facts with dimensions, the area restriction runs on the dimension side before the
    large joins. No id list is collected; the semi-join strategy is planned from the
    zone table's size statistics.
    """
    ids = area.select(F.col("zone_id").cast("long"))
    return trips.filter(F.col("pu_zone").isin(ids) & F.col("do_zone").isin(ids))


def clean_trips(trips: DataFrame, area: DataFrame, lo: str, hi: str, strict: bool = False) -> DataFrame:
    """Typed trips with both times in ``[lo, hi)`` and both ends in the area.

    The time predicates sit directly on the source columns, so Catalyst pushes them into
    the scans (and through the joins of a bound source).
    """
    t = typed_trips(trips)
    t = t.filter(in_range(F.col("pickup"), lo, hi, strict) & in_range(F.col("dropoff"), lo, hi, strict))
    return trips_in_area(t, area)


def trip_rejects(trips: DataFrame) -> DataFrame:
    """Rows whose casts failed (any null among the four typed columns)."""
    t = typed_trips(trips)
    return t.filter(F.col("pickup").isNull() | F.col("dropoff").isNull()
                    | F.col("pu_zone").isNull() | F.col("do_zone").isNull())


def split_history_live(events: DataFrame, cut: str, time_col: str = "time") -> DataFrame:
    """Tag each row ``history`` (time < cut) or ``live`` (time >= cut): every row on exactly one side."""
    return events.withColumn(
        "part", F.when(F.col(time_col) < F.lit(cut).cast("timestamp_ntz"), F.lit("history")).otherwise(F.lit("live")))
