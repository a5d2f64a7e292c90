"""Session settings that suit the operators; everything stays overridable by the caller."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | None = None, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{n}]").config("spark.driver.memory", memory)
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(n), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset and the
    session is local (tests) a temporary one, kept for the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="lodestar-")
    atexit.register(shutil.rmtree, own, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what several branches read is worked out once, plans stay
    short, and a lost executor costs no earlier stage."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/lodestar/stage-{uuid.uuid4().hex[:12]}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").mode("overwrite").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
