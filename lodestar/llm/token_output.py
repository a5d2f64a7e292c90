"""Token-ID output: bit-plane shuffled, zstandard-compressed shards with a chunk index.

Format of a shard (all integers little-endian)::

    magic "LSBP"  u32 version  u32 block  u32 mode (0 byte planes, 1 bit planes)
    u64 documents  u64 ids  u64 index offset
    planes: for each block of `block` ids (the last one may be shorter) its planes, one zstandard
            frame each; a plane of zeros only takes no bytes
    index:  zstandard frame of, for each block: u64 offset, u32 ids, u32 planes, planes x u32 length;
            then the document table: i64 doc_id, u64 first id, u64 ids, u8 doc_id is null

Any block can be read alone. Ids that fit 16 bits leave the two high byte planes empty.

Shards are files, shards/PART-SHARD.lsbp under the dataset's folder, written by the task that encodes
them under a name of their own and then renamed, so a task that runs again does no harm. Beside them
Spark writes a manifest, a Parquet table with a row for each shard. In a store that only Spark reaches
the manifest holds the shards themselves, as binary values.

Defined results: null and empty texts are documents of the end id alone; equal ids and repeated rows
keep all their rows, in order of the ids and a hash of the text; null ids come first; an empty table
gives an empty dataset; other columns are ignored; a text of any length is one document.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .encoding import CACHE_WORDS, encoder, tokenizer_path

MAGIC, VERSION = b"LSBP", 1
HEADER = struct.Struct("<4sIIIQQQ")
BLOCK = 1 << 16
#: A shard is closed once it has so many ids; a longer document is a shard of its own.
SHARD_IDS = 1 << 20
SHARD_SCHEMA = "part long, shard long, first long, n_docs long, n_ids long, file string, content binary"
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block: plane k holds byte k (or bit k) of every id."""
    raw = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    rows = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(rows[:, k]).tobytes() for k in range(32)]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block of n."""
    if len(planes) == 4:
        raw = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            if p:
                raw[:, k] = np.frombuffer(p, dtype=np.uint8)
        return raw.reshape(-1).view("<u4")
    rows = np.zeros((n, 32), dtype=np.uint8)
    for k, p in enumerate(planes):
        if p:
            rows[:, k] = np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n)
    return np.packbits(rows, axis=1, bitorder="little").reshape(-1).view("<u4")


def write_shard(docs: list[tuple[int | None, bytes]], block: int = BLOCK, bits: bool = False, level: int = 1) -> bytes:
    """A shard of documents: (doc_id, ids as little-endian u32)."""
    ids = np.frombuffer(b"".join(x for _, x in docs), dtype="<u4")
    pack = zstandard.ZstdCompressor(level=level)
    out, index, at = [], [], HEADER.size
    for i in range(0, len(ids), block):
        part = ids[i : i + block]
        frames = [pack.compress(p) if any(p) else b"" for p in split_planes(part, bits)]
        index.append(struct.pack(f"<QII{len(frames)}I", at, len(part), len(frames), *map(len, frames)))
        out += frames
        at += sum(map(len, frames))
    counts = np.array([len(x) // 4 for _, x in docs], dtype="<u8")
    starts = np.concatenate([np.zeros(1, "<u8"), np.cumsum(counts)[:-1]]).astype("<u8") if docs else counts
    table = np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes() + starts.tobytes() + counts.tobytes() + bytes(d is None for d, _ in docs)
    tail = pack.compress(struct.pack("<I", len(index)) + b"".join(index) + table)
    return b"".join([HEADER.pack(MAGIC, VERSION, block, int(bits), len(docs), len(ids), at), *out, tail])


class Shard:
    """Reads a shard; ids(first, n) touches only the blocks that it needs."""

    def __init__(self, content: bytes):
        magic, version, self.block, _, self.n_docs, self.n_ids, at = HEADER.unpack_from(content)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of this version")
        self.content = content
        self.unpack = zstandard.ZstdDecompressor()
        tail = self.unpack.decompress(content[at:])
        (n,), at = struct.unpack_from("<I", tail), 4
        self.blocks = []
        for _ in range(n):
            offset, size, planes = struct.unpack_from("<QII", tail, at)
            lengths = struct.unpack_from(f"<{planes}I", tail, at + 16)
            self.blocks.append((offset, size, lengths))
            at += 16 + 4 * planes
        d = self.n_docs
        self.doc_ids = np.frombuffer(tail, "<i8", d, at)
        self.starts = np.frombuffer(tail, "<u8", d, at + 8 * d).astype(np.int64)
        self.counts = np.frombuffer(tail, "<u8", d, at + 16 * d).astype(np.int64)
        self.nulls = np.frombuffer(tail, np.uint8, d, at + 24 * d).astype(bool)

    def read_block(self, k: int) -> np.ndarray:
        at, n, lengths = self.blocks[k]
        planes = []
        for m in lengths:
            planes.append(self.unpack.decompress(self.content[at : at + m]) if m else b"")
            at += m
        return join_planes(planes, n)

    def ids(self, first: int = 0, n: int | None = None) -> np.ndarray:
        last = self.n_ids if n is None else first + n
        if last <= first:
            return np.zeros(0, "<u4")
        k0, k1 = first // self.block, (last - 1) // self.block
        got = np.concatenate([self.read_block(k) for k in range(k0, k1 + 1)])
        return got[first - k0 * self.block : last - k0 * self.block]


def _store(uri: str) -> tuple[fs.FileSystem, str] | None:
    """The file system of a path and the path in it; None where only Spark reaches it."""
    try:
        return fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _write_file(uri: str, content: bytes) -> None:
    """The file appears whole or not at all."""
    store, at = _store(uri)
    own = f"{at}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own) as out:
        out.write(content)
    store.move(own, at)


def read_file(uri: str) -> bytes:
    store, at = _store(uri)
    with store.open_input_file(at) as f:
        return f.read()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, blanks_count: bool = True, bits: bool = False, partitions: int | None = None, cache_words: int = CACHE_WORDS) -> None:
    """Encode documents (doc_id, text) and write shards in ascending order of doc_id to path.

    One range-partitioned shuffle carries the texts; each task encodes its range and cuts shards, and
    knows how many ids of its part went before each."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    end = np.array([end_id], dtype="<u4").tobytes()
    out_schema = common.fields(SHARD_SCHEMA)
    folder = None
    if (store := _store(f"{path}/shards")) is not None:
        store[0].create_dir(store[1], recursive=True)
        folder = f"{path}/shards"

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, blanks_count, cache_words)
        held: list[tuple[int | None, bytes]] = []
        size, shard, part, first = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "shard": shard, "first": first, "n_docs": len(held), "n_ids": size // 4}
            content = write_shard(held, bits=bits)
            if folder is None:
                row["content"] = content
            else:
                row["file"] = f"{folder}/{part:05d}-{shard:05d}.lsbp"
                _write_file(row["file"], content)
            return pa.RecordBatch.from_pylist([row], out_schema)

        for batch in common.sliced(batches, 4 << 20):
            part = batch.column(2)[0].as_py()
            for doc, ids in zip(batch.column(0).to_pylist(), enc.ids(common.texts_of(batch)), strict=True):
                held.append((doc, ids + end))
                size += len(ids) + 4
                if size >= 4 * SHARD_IDS:
                    yield close()
                    first += size // 4
                    held, size, shard = [], 0, shard + 1
        if held:
            yield close()

    rows.mapInArrow(encode, SHARD_SCHEMA).write.mode("overwrite").parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a written dataset, from the shards: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32. The driver sees the total of each part, and there are as
    many parts as the write had partitions."""
    shards = spark.read.parquet(f"{path}/manifest")
    totals = sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = {}, 0
    for r in totals:
        before[r["part"]] = total
        total += r["n"]
    out_schema = common.fields(DOC_SCHEMA)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("shards", lambda: None)
        for batch in batches:
            for part, first, file, content in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                shard = Shard(content if file is None else read_file(file))
                raw = memoryview(shard.ids().tobytes())
                crcs = [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(shard.starts.tolist(), shard.counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, mask=shard.nulls), pa.array(shard.starts + (before[part] + first)), pa.array(shard.counts), pa.array(crcs, pa.int64())], schema=out_schema)

    # rows of the manifest are small and the shards behind them are not: dealt out by their names
    rows = shards.select("part", "first", "file", "content")
    if (n := shards.count()) > 1 and _store(path) is not None:
        rows = rows.repartition(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    return rows.mapInArrow(decode, DOC_SCHEMA)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of `documents`, encoded, written and read back."""
    path = common.scratch(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path)
