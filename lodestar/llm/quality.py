"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters run over chunks of CHUNK bytes that overlap by half and cover the whole
document, each filter's rectified answers are max-pooled over the document, and a logistic unit
combines them into one probability (1: good). Memory does not grow with a text: it passes in segments
that overlap by the half chunk they share.

The network is fitted at the driver on a bounded sample of labelled rows: SAMPLE rows of each label in
expectation, chosen by a hash of the id, their whole texts. The number of rows is bounded, their
length is not: texts pass in groups of GROUP bytes here too.

Defined results: null and empty texts are scored as an empty chunk; repeated rows are scored each, and
equal texts alike; a score of exactly the threshold counts as good; labels other than 0 and 1 are
ignored, of several labels of one id the least counts; without labelled rows of both kinds every score
is the share of good labels, or 1 without labels; an empty table gives no rows; other columns are
ignored by predict and kept by good_documents, whatever they are called; texts of any length are read
whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

HALF, DIM, FILTERS = 8, 8, 24
CHUNK = 2 * HALF
SAMPLE = 1200
SEGMENT = 1 << 15
GROUP = 1 << 19
THRESHOLD = 0.7


def blocks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in blocks of HALF with an empty block after each segment; where segments start; whose
    they are. Segments of a long text share a block, so that no chunk is lost between them. The empty
    block only ends the last chunk: what begins there would reach into the next segment."""
    parts, starts, owner, at = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), SEGMENT):
            part = t[a : a + SEGMENT + HALF]
            pad = -len(part) % HALF + (HALF if part else CHUNK)
            parts += [part, bytes(pad)]
            starts.append(at)
            owner.append(i)
            at += (len(part) + pad) // HALF
    return np.frombuffer(b"".join(parts), np.uint8), np.array(starts), np.array(owner)


def answers(net: dict, raw: np.ndarray) -> np.ndarray:
    """Each filter's answer to the chunk that begins at each block (the last begins no chunk)."""
    x = net["embed"][raw].reshape(-1, HALF * DIM)
    y = x @ net["conv"]  # first halves | second halves
    out = y[:, :FILTERS].copy()
    out[:-1] += y[1:, FILTERS:]
    out += net["bias"]
    return out


def pooled(net: dict, texts: list[bytes]) -> np.ndarray:
    """Max-pooled, rectified answers of each text."""
    out = np.zeros((len(texts), FILTERS), np.float32)
    group, size, first = [], 0, 0

    def run() -> None:
        raw, starts, owner = blocks_of(group)
        y = answers(net, raw)
        y[np.append(starts[1:], len(y)) - 1] = -np.inf
        best = np.maximum.reduceat(y, starts, axis=0)
        np.maximum.at(out, first + owner, best)

    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), GROUP):  # a text longer than a group passes piece by piece
            piece = t[a : a + GROUP + HALF]
            if group and (size + len(piece) > GROUP or a):
                run()
                group, size = [], 0
            if not group:
                first = i
            group.append(piece)
            size += len(piece)
    if group:
        run()
    return out


def winners(net: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The answer that wins the pooling of each text and filter, and the bytes of its chunk."""
    top = np.full((len(texts), FILTERS), -np.inf, np.float32)
    chunk = np.zeros((len(texts), FILTERS, CHUNK), np.uint8)
    pieces = [(i, t[a : a + GROUP + HALF]) for i, t in enumerate(texts) for a in range(0, max(1, len(t)), GROUP)]
    while pieces:
        n, size = 1, len(pieces[0][1])
        while n < len(pieces) and size + len(pieces[n][1]) <= GROUP:
            size += len(pieces[n][1])
            n += 1
        raw, starts, owner = blocks_of([p for _, p in pieces[:n]])
        y, blocks = answers(net, raw), raw.reshape(-1, HALF)
        for s, e, k in zip(starts, np.append(starts[1:], len(y)), owner, strict=True):
            i, at = pieces[k][0], s + y[s : e - 1].argmax(axis=0)
            best = y[at, np.arange(FILTERS)]
            more = best > top[i]
            top[i, more] = best[more]
            chunk[i, more] = np.concatenate([blocks[at], blocks[at + 1]], axis=1)[more]
        pieces = pieces[n:]
    return top, chunk


def score(net: dict, texts: list[bytes]) -> np.ndarray:
    if "prior" in net:
        return np.full(len(texts), net["prior"])
    z = pooled(net, texts).astype(np.float64) @ net["out"] + net["out_bias"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 14, seed: int = 7, rate: float = 0.01) -> dict:
    """Adam on the logistic loss, classes weighted alike. Only the chunks that win the pooling carry
    a gradient."""
    labels = np.asarray(labels, np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        return {"prior": float(labels.mean()) if len(labels) else 1.0}
    rng = np.random.default_rng(seed)
    net = {
        "embed": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
        "conv": rng.normal(0, (CHUNK * DIM) ** -0.5, (HALF * DIM, 2 * FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.3, FILTERS),
        "out_bias": np.zeros(1),
    }
    share = labels.mean()
    weight = np.where(labels > 0.5, 0.5 / share, 0.5 / (1 - share))
    m = {k: (np.zeros(v.shape), np.zeros(v.shape)) for k, v in net.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), 32):
            at = order[a : a + 32]
            top, chunk = winners(net, [texts[i] for i in at])
            n = len(at)
            h = np.maximum(top, 0).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(h @ net["out"] + net["out_bias"], -30, 30)))
            dz = (p - labels[at]) * weight[at] / n
            grads = {"out": h.T @ dz + 1e-4 * net["out"], "out_bias": np.array([dz.sum()])}
            dh = dz[:, None] * net["out"][None] * (top > 0)
            grads["bias"] = dh.sum(axis=0)
            conv, embed = np.zeros(net["conv"].shape), np.zeros(net["embed"].shape)
            for f in range(FILTERS):
                d = dh[:, f]
                live = np.flatnonzero(d)
                if not len(live):
                    continue
                first, second = chunk[live, f, :HALF], chunk[live, f, HALF:]
                for half, column in ((first, f), (second, FILTERS + f)):
                    x = net["embed"][half].reshape(len(live), -1)
                    conv[:, column] += x.T @ d[live]
                    np.add.at(embed, half.reshape(-1), (d[live, None] * net["conv"][:, column][None]).reshape(-1, DIM))
            grads |= {"conv": conv, "embed": embed}
            step += 1
            lr = rate * (1 - 0.9 * epoch / epochs)
            for k, g in grads.items():
                a1, a2 = m[k]
                a1 += 0.1 * (g - a1)
                a2 += 0.001 * (g * g - a2)
                net[k] = (net[k] - lr * (a1 / (1 - 0.9**step)) / (np.sqrt(a2 / (1 - 0.999**step)) + 1e-8)).astype(net[k].dtype)
    return net


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The network from labelled rows; labels: (doc_id, quality)."""
    named = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in named.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    spot = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 20))
    kept = F.lit(False)
    for k, n in sizes.items():
        kept = kept | ((F.col("quality") == k) & (spot < int(min(1.0, sample / n) * (1 << 20)) + (n <= sample)))
    # the chosen ids are SAMPLE of each label in expectation: small enough to send to every task
    chosen = F.broadcast(named.where(kept))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "utf-8").alias("raw")).where(F.col("raw").isNotNull()).join(chosen, "doc_id")
    found = rows.select("doc_id", "raw", "quality").toPandas().sort_values(["doc_id", "raw"])
    net = train([bytes(x) for x in found["raw"]], found["quality"].to_numpy(np.float64))
    del found
    common.trim()
    return net


def predict(docs: DataFrame, net: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row of docs."""
    schema = "doc_id long, score double, predicted int"
    out_schema = common.fields(schema)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("quality", lambda: None)
        for batch in common.sliced(batches):
            s = score(shared.value, [t.encode("utf-8", "surrogatepass") for t in common.texts_of(batch)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], schema=out_schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def good_documents(docs: DataFrame, net: dict, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score below threshold; all columns stay."""
    names = docs.columns
    renamed = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("quality", lambda: None)
        for batch in common.sliced(batches, name=f"__c{at}"):
            s = score(shared.value, [(x or "").encode() for x in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(s >= threshold))

    return renamed.mapInArrow(run, renamed.schema).toDF(*names)


def held_out() -> F.Column:
    """The rows whose labels fitting never sees."""
    return F.pmod(common.crc_of_id(F.col("doc_id")), F.lit(4)) == 2


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every text of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()))
    return predict(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
