"""Streaming sources of flow events.

The message log of the reference carries JSON ``{"region_id": .., "time": ".."}`` per
topic. Here a stream row is ``topic, value`` whether it comes from Kafka (option-driven;
the connector jar must be on the classpath) or from JSON-lines files with the same two
fields, and one parser turns it into ``flow_type, time, region_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.events import parse_payload

OFFSET_MESSAGE = "topic string, offset bigint, value string"
MESSAGE = T.StructType([T.StructField("topic", T.StringType(), True), T.StructField("value", T.StringType(), True)])


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topics from the beginning (``startingOffsets=earliest``) -> ``topic, value``.
    ``max_offsets_per_trigger`` keeps a long backlog from becoming one first batch."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = r.load()
    return raw.select(F.col("topic"), F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files of ``{"topic": .., "value": ..}`` read as a stream."""
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def offset_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files of ``{"topic": .., "offset": .., "value": ..}``: the file form of a log whose
    records keep their place (a Kafka source gives the same columns)."""
    r = spark.readStream.schema(OFFSET_MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def placed_events(messages: DataFrame) -> DataFrame:
    """``topic, offset, value`` -> ``flow_type, time, region_id, offset``."""
    return parse_payload(messages, keep=["offset"])


def event_files(spark: SparkSession, path: str, flow_type: str, max_files_per_trigger: int | None = None,
                fmt: str = "json") -> DataFrame:
    """Files of one topic holding plain ``{"time", "region_id"}`` rows (permissive JSON:
    malformed rows come through with null fields and are split off by ``split_rejects``)."""
    r = spark.readStream.schema(schemas.FLOW_EVENT_JSON).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.format(fmt).load(path).select(F.lit(flow_type).alias("flow_type"), "time", "region_id")


def flow_events(messages: DataFrame) -> DataFrame:
    """``topic, value`` -> ``flow_type, time, region_id``."""
    return parse_payload(messages)


def is_valid(df: DataFrame) -> F.Column:
    return F.col("time").isNotNull() & F.col("region_id").isNotNull() & F.col("flow_type").isNotNull()


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects): a null time would be silently skipped by the window and a null
    zone counted as a zone of its own, so both go to the rejects before counting."""
    return df.filter(is_valid(df)), df.filter(~is_valid(df))
