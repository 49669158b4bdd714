"""Partitioned logs as DataFrames: files of records with their envelope, read whole or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def read(spark: SparkSession, path: str, *, file_format: str = "parquet", schema: T.StructType = ENVELOPE, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """A log kept as files whose rows carry topic, partition, offset and timestamp."""
    reader = (spark.readStream if stream else spark.read).format(file_format).schema(schema)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_broker(spark: SparkSession, servers: str, topics: list[str], *, stream: bool = True, start: str = "earliest", **options: str) -> DataFrame:
    """A log in a message broker, through Spark's connector for it, which must be on the class path.

    ``start`` holds for the first run only; later ones go on from the stream's checkpoint.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    found = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", start).options(**options).load()
    return found.select("topic", "partition", "offset", "timestamp", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def whole_millis(when: Column) -> Column:
    """A time in whole milliseconds, as brokers count: the nearest, halves away from 1970, without floating point."""
    return F.timestamp_micros(F.round(F.unix_micros(when), -3))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``events`` as a change log of four partitions; the key is the user, the operation follows the type."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    return e.select(
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").alias("key"),
        op.alias("op"),
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
    )
