"""The stage trace: an append-only table of events, and reading it as a stream."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "run_id string, stage_id string, created_at string, core string, params string, meta string"


def append(spark: SparkSession, path: str, run_id: str, stage_id: str, core: object, params: object, meta: object, created_at: str | None = None) -> None:
    """Add one event as a JSON line."""
    row = (run_id, stage_id, created_at or datetime.now(UTC).isoformat(), *[json.dumps(x, ensure_ascii=False) for x in (core, params, meta)])
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").json(path)


def events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def counters(df: DataFrame, **counts) -> DataFrame:
    """df that reports counts (named columns of aggregates) when it runs, without a pass of its own."""
    return df.observe("counters", *[c.alias(n) for n, c in counts.items()])


def deduplicated_stream(spark: SparkSession, path: str, late: str = "1 hour") -> DataFrame:
    """Events as a stream, each (run, stage, time) once; state goes after `late`. An extension: batch
    runs do not need it."""
    rows = spark.readStream.schema(SCHEMA).json(path).withColumn("at", F.to_timestamp("created_at"))
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["run_id", "stage_id", "created_at"])


def stage_counts(stream: DataFrame, window: str = "10 minutes") -> DataFrame:
    return stream.groupBy(F.window("at", window), "stage_id").agg(F.count("*").alias("events"))


def to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
