"""What the operators share: the shared folder, written tables, and Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/lodestar/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str, few: bool = False) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and a lost executor costs nothing. few: of
    a proven small number of rows, which go to one file."""
    at = scratch(df.sparkSession, tag)
    df = df.repartition(1) if few else df
    # without a file that says it is done: nothing reads it, and the driver is spared a process for it
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").mode("overwrite").parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.written_at = at
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing will read any more."""
    for df in tables:
        if df is not None:
            jvm, at = df.sparkSession._jvm, df.written_at
            where = jvm.org.apache.hadoop.fs.Path(at)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


_held: dict[str, Callable[[], None]] = {}


def hold(name: str, release: Callable[[], None]) -> None:
    """Say that this worker now uses the cache `name`: caches of other operators that ran in the same
    worker before are released, so that they do not add up."""
    others = [x for x in _held if x != name]
    for other in others:
        _held.pop(other)()
    if others:
        trim()
    _held[name] = release


def trim() -> None:
    """Hand what is free back to the system: workers wait for tasks while the JVM needs the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: No key that one task joins has more than about this share of all rows.
SHARES = 2048


def counted_join(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int | None = None) -> DataFrame:
    """rows joined with table, which has one row a key and in `count` how many rows the key has. Keys of
    many rows go by a broadcast, of SHARES rows at most: each has more than one in SHARES of all rows.
    The others meet by a shuffle, which no key can make uneven."""
    limit = max(1, (rows.count() if total is None else total) // SHARES)
    names = [c for c in table.columns if c not in keys and (c != count or count not in rows.columns)]
    many = table.where(F.col(count) > limit).select(*keys, *names)
    few = table.where(F.col(count) <= limit).select(*keys, *names)
    rest = rows.join(F.broadcast(many.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(many), keys).unionByName(rest.join(few.hint("merge"), keys))


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of an id as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch; null is the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def sliced(batches, most_bytes: int = 4 << 20, name: str = "text", release: Callable[[], None] | None = None):
    """Arrow batches cut so that each holds about most_bytes of text at most, or one row. After the
    last one a cache that need not outlive the task is released, and free memory goes back."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist() if batch.num_rows else []
        total = start = 0
        for at, n in enumerate(lengths):
            if at > start and total + n > most_bytes:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += n
        if lengths:
            yield batch.slice(start)
        del batch, column
    if release:
        release()
    trim()


def fields(schema: str) -> pa.Schema:
    """An Arrow schema from 'name type, ...' of the few types used here."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "longs": pa.list_(pa.int64()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])
