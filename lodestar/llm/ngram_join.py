"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

1. Each document becomes the set of its word n-grams (as 64-bit hashes). Documents with equal sets
   are one class from here on, so copies are never paired. A sketch, whose width follows the size of
   the corpus up to WIDEST, counts in how many documents n-grams occur, over the whole corpus; it gives
   the order, rare first. Any order gives the same links; the sketch only decides how many candidates.
2. Each class puts its prefix into an index by n-gram. Two classes that link share an n-gram there.
3. Where an n-gram has several classes, the first ones are candidates with the others that length and
   position allow: stars, not all pairs. Each round takes more middles a group (HUBS), and those it took
   leave the group. Classes that links have joined already need no more; a group ends when all that are
   left in it are in one component, or have been a middle. So no link between components is missed.
4. A pair is verified once, after a suffix filter, on the two whole sets. Links give components.

An n-gram that very many classes have is dealt over salts wherever rows meet by n-gram, in proportion
to its share of all rows (SHARES).

Defined results: null texts and texts without words have no n-grams and link with nothing; a text of
fewer words than n is one n-gram; rows with one doc_id are documents of their own with that id; null
ids never name a component unless it has no other; empty tables give no rows; other columns are
ignored by near_duplicates and kept by unique_documents; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components

#: Counters of the sketch (powers of two), and of one row that carries a part of it. There is a counter
#: for each CHARS characters of text, up to WIDEST: what is sent to every task is 8 MB at most.
NARROWEST, WIDEST, PART, CHARS = 1 << 16, 1 << 23, 1 << 14, 25
#: Up to this a counter's level is its count, beyond it a logarithm.
PLAIN = 32
KEPT_WORDS = 300_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: Middles of a group by round; the last number holds for all later rounds.
HUBS = (1, 16, 256, 1024)
#: No group of rows that one task takes is more than about this share of all rows.
SHARES = 2048
#: Pairs of a hub that one task takes, and pairs whose ids may be sent to all tasks (24 bytes each).
STAR = 2000
BROADCAST_KEYS = 200_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            self[word] = h
        return h


_words = _Words()


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the word n-grams of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00short\x00" + b" ".join(words))], np.uint64) if words else np.zeros(0, np.uint64)
    if len(_words) > KEPT_WORDS:
        _words.clear()
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(w) - k + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h ^= h >> np.uint64(29)
            h = (h + w[j : j + n]) * MIX[j % 3]
        h ^= h >> np.uint64(32)
    return np.unique(h)


def set_id(s: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def _width(docs: DataFrame) -> int:
    """Counters that a corpus gets, from the length of its texts."""
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    return min(WIDEST, max(NARROWEST, 1 << (chars // CHARS).bit_length()))


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes, in the same order but for ties."""
    far = PLAIN + 8 * np.log2(np.maximum(counts, PLAIN) / PLAIN)
    return np.where(counts <= PLAIN, counts, np.minimum(far, 255)).astype(np.uint8)


def _places(s: np.ndarray, width: int) -> np.ndarray:
    """The counters of n-grams."""
    return (s >> np.uint64(65 - width.bit_length())).astype(np.int64)


def _index(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n, sid and row (what finds the text again) of every document; and the sketch's levels."""
    schema = "doc_id long, n long, sid long, row long, part int, counts binary"
    out_schema = common.fields(schema)
    width = _width(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("words", _words.clear)
        counts = np.zeros(width, np.uint32)
        for batch in common.sliced(batches, 2 << 20, release=_words.clear):
            found = [shingles(text, k) for text in batch.column(1).to_pylist()]
            ns, sids = [len(s) for s in found], [set_id(s) for s in found]
            if found:
                np.add.at(counts, _places(np.concatenate(found), width), np.uint32(1))
            none = pa.nulls(len(ns))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(sids, pa.int64()), batch.column(2), none.cast(pa.int32()), none.cast(pa.binary())], schema=out_schema)
        pack = zstandard.ZstdCompressor(level=1)
        for p in range(0, width, PART):
            if counts[p : p + PART].any():
                yield pa.RecordBatch.from_pylist([{"part": p // PART, "counts": pack.compress(counts[p : p + PART].tobytes())}], out_schema)

    both = common.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _row().alias("row")).mapInArrow(run, schema), "shingles")
    total_schema = common.fields("part int, counts binary")

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = np.frombuffer(unpack.decompress(c), np.uint32).astype(np.int64)
                sums[p] = sums[p] + got if p in sums else got
        for p, c in sums.items():
            yield pa.RecordBatch.from_pylist([{"part": p, "counts": _levels(c).tobytes()}], total_schema)

    levels = np.zeros(width, np.uint8)  # WIDEST at most: 8 MB at the driver
    for r in both.where("part is not null").select("part", "counts").repartition(min(64, width // PART), "part").mapInArrow(total, "part int, counts binary").toLocalIterator():
        levels[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.uint8)
    return both.where("part is null").select("doc_id", "n", "sid", "row"), levels


def _row() -> F.Column:
    """What a row's text is found again by: its id, or for a null id a hash of the text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))


def _prefixes(docs: DataFrame, k: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """token, sid, n, pos: a row for each n-gram in the prefix of a class (a class may come once a task)."""
    out_schema = common.fields("token long, sid long, n int, pos int")
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("words", _words.clear)
        levels = shared.value
        seen: set[int] = set()
        for batch in common.sliced(batches, 2 << 20, release=_words.clear):
            tokens, sids, ns, poss = [], [], [], []
            for text in batch.column(0).to_pylist():
                s = shingles(text, k)
                n, sid = len(s), set_id(s)
                if sid is None or sid in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(sid)
                p = prefix_length(n, num, den)
                # a level, then 56 bits of the hash: one order over all n-grams
                key = (levels[_places(s, len(levels))].astype(np.uint64) << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))
                tokens.append(np.sort(np.partition(key, p - 1)[:p] if p < n else key))
                sids.append(np.full(p, sid, np.int64))
                ns.append(np.full(p, n, np.int32))
                poss.append(np.arange(p, dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ([t.astype(np.int64) for t in tokens], sids, ns, poss)], schema=out_schema)

    return common.written(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token long, sid long, n int, pos int"), "prefixes")


def _allowed(a: F.Column, b: F.Column, num: int, den: int) -> F.Column:
    """Length and positional filters on two structs with n and pos."""
    sizes = (F.least(a["n"], b["n"]).cast("long") * den) >= (F.greatest(a["n"], b["n"]).cast("long") * num)
    most = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return sizes & ((most.cast("long") * (num + den)) >= ((a["n"] + b["n"]).cast("long") * num))


def _overlap(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """|a & b|, or less than need where halving the hash range shows that it can't reach it."""
    if min(len(a), len(b)) < need:
        return 0
    cuts = [0, *(np.uint64(q << 61) for q in range(1, 8))]
    i, j = np.append(a.searchsorted(cuts), len(a)), np.append(b.searchsorted(cuts), len(b))
    if int(np.minimum(np.diff(i), np.diff(j)).sum()) < need:
        return 0
    at = np.minimum(b.searchsorted(a), len(b) - 1)
    return int((b[at] == a).sum())


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (hub, other) that link, as (a, b), verified on whole sets.

    One text of each class that has a pair becomes its set, and goes once to each hub it is paired
    with; a hub of many pairs is dealt over salts. At a hub's place its own set comes first and is held
    while the others pass."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / STAR).cast("int").alias("s"))
    members = pairs.join(sizes, "hub").select(F.col("other").alias("sid"), "hub", F.pmod(F.xxhash64("other"), F.col("s")).cast("int").alias("salt"), F.lit(1).alias("role"))
    heads = sizes.select(F.col("hub").alias("sid"), "hub", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("salt"), F.lit(0).alias("role"))
    keys = members.unionByName(heads).groupBy("sid").agg(F.collect_list(F.struct("hub", "salt", "role")).alias("keys"))
    ids = common.written(keys.join(classes, "sid").select(F.col("row").alias("__row"), "sid", "keys"), "keys")
    # the ids of pairs go to all tasks only up to a size that is counted; else the texts meet them by key
    near = F.broadcast(ids) if (ids.agg(F.sum(F.size("keys"))).first()[0] or 0) <= BROADCAST_KEYS else ids
    rows = docs.select(_row().alias("row"), F.col("text").cast("string").alias("text"))
    found = rows.join(near, F.col("row") == F.col("__row")).select("text", "sid", "keys")
    schema = "hub long, salt int, role int, items binary, sid long"
    set_schema = common.fields(schema)

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("words", _words.clear)
        made: set[int] = set()
        for batch in common.sliced(batches, 1 << 20, release=_words.clear):
            out: list[tuple] = []
            size = 0
            for text, sid, keys in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if sid in made:  # copies under one id, or without one
                    continue
                s = shingles(text, k)
                if set_id(s) != sid:  # rows that only share the id drop out
                    continue
                made.add(sid)
                raw = s.tobytes()
                for key in keys:
                    out.append((key["hub"], key["salt"], key["role"], raw, sid))
                    size += len(raw)
                    if size > 8 << 20:
                        yield _batch(out, set_schema)
                        out, size = [], 0
            if out:
                yield _batch(out, set_schema)

    out_schema = common.fields("a long, b long")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            hubs, salts, roles, sids = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for i, (hub, salt, role, sid) in enumerate(zip(hubs, salts, roles, sids, strict=True)):
                if role == 0:
                    at, own = (hub, salt), np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                elif at == (hub, salt):
                    other = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                    need = -(-num * (len(own) + len(other)) // (num + den))
                    if _overlap(own, other, need) >= need:
                        a.append(hub)
                        b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=out_schema)

    dealt = found.mapInArrow(sets, schema).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")
    return common.written(dealt.mapInArrow(check, "a long, b long"), "links")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _met(rows: DataFrame, table: DataFrame, total: int) -> DataFrame:
    """rows with what table has for their token; both have c, about how many rows the token has. A
    token of many rows is dealt over salts, so that none is more than a small share of all."""
    share = max(1, total // SHARES)
    salts = lambda: F.ceil(F.col("c") / share).cast("int")
    left = rows.withColumn("__salt", F.pmod(F.xxhash64("sid"), salts()).cast("int"))
    right = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts() - 1))).drop("c")
    # always by a shuffle: shared n-grams grow with the corpus
    return left.join(right.hint("merge"), ["token", "__salt"]).drop("__salt")


def _shared(prefixes: DataFrame) -> DataFrame:
    """token, sid, n, pos, c, label of the n-grams that several classes have in their prefixes."""
    tokens = prefixes.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("token", "c")
    tokens = common.written(tokens, "tokens")
    limit = max(1, prefixes.count() // SHARES)
    # at most SHARES of them: each has more than one in SHARES of all rows
    hot = tokens.where(F.col("c") > limit)
    cold = prefixes.join(F.broadcast(hot.select("token")), "token", "left_anti").join(tokens.where(F.col("c") <= limit).hint("merge"), "token")
    both = [x.groupBy("token", "sid").agg(F.first("n").alias("n"), F.min("pos").alias("pos"), F.first("c").alias("c")) for x in (cold, prefixes.join(F.broadcast(hot), "token"))]
    out = common.written(both[0].unionByName(both[1]).withColumn("label", F.col("sid")), "groups")
    common.discard(tokens, prefixes)
    return out


def _open(rows: DataFrame, total: int, num: int, den: int) -> DataFrame:
    """Rows of groups with several labels, less those that no member of their group can match: what
    follows a row's place is too little even for the shortest member."""
    groups = rows.groupBy("token").agg(F.min("n").alias("shortest"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.first("c").alias("c"))
    fit = ((F.col("n") - F.col("pos")).cast("long") * (num + den)) >= ((F.col("n") + F.col("shortest")).cast("long") * num)
    kept = _met(rows, groups.where("lo < hi").select("token", "shortest", "c"), total).where(fit).drop("shortest")
    return kept


def links(docs: DataFrame, indexed: DataFrame, levels: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """(node, component) of the classes that link with another; component is the least sid."""
    classes = indexed.where("sid is not null").groupBy("sid").agg(F.min("row").alias("row"))
    rows = _shared(_prefixes(docs, k, num, den, levels))
    total = rows.count()
    active = rows
    tried = edges = labels = None
    place = F.struct("pos", "sid", "n", "label")
    round_ = 0
    while not active.isEmpty():
        most = HUBS[min(round_, len(HUBS) - 1)]
        round_ += 1
        # the middles of a group are the members with least before the n-gram, so likely the least
        # edited. Only the first few of each task pass the window's shuffle
        first = active.withColumn("__r", F.row_number().over(Window.partitionBy("token").orderBy("pos", "sid"))).where(F.col("__r") <= most)
        hubs = first.groupBy("token").agg(F.collect_list(place).alias("h"), F.max(F.struct("pos", "sid")).alias("last"), F.first("c").alias("c"))
        near = F.filter("h", lambda x: (F.struct(x["pos"], x["sid"]) < F.struct("pos", "sid")) & (x["label"] != F.col("label")) & _allowed(x, place, num, den))
        met = _met(active, hubs, total).select("token", "sid", "n", "pos", "c", "label", F.transform(near, lambda x: x["sid"]).alias("h"), (F.struct("pos", "sid") > F.col("last")).alias("later"))
        met = common.written(met, "met")
        pairs = met.select(F.explode("h").alias("hub"), F.col("sid").alias("other"))
        pairs = pairs.groupBy(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b")).agg(F.min("hub").alias("hub"))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = common.written(pairs.select("a", "b", "hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("other")), "pairs")
        if not pairs.isEmpty():
            new = _verified(pairs.select("hub", "other"), docs, classes, k, num, den)
            edges = new if edges is None else edges.unionByName(new)
            tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
            labels = components(edges)
        later = met.where("later").drop("h", "later")
        if labels is not None:
            later = later.drop("label").join(labels, later["sid"] == labels["node"], "left").select("token", "sid", "n", "pos", "c", F.coalesce("component", "sid").alias("label"))
        before, active = active, common.written(_open(later, total, num, den), "open")
        common.discard(before, met)
    if labels is None:
        return docs.sparkSession.createDataFrame([], "node long, component long")
    return labels


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """For each row of docs (doc_id, text): doc_id, n_shingles, sid (equal for equal sets, null for
    none) and component_id, the smallest doc_id that links of num/den or more reach."""
    indexed, levels = _index(docs, k)
    labels = links(docs, indexed, levels, k, num, den)
    least = indexed.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("m"), F.count("*").alias("rows"))
    placed = least.join(labels, least["sid"] == labels["node"], "left").select("sid", "m", "rows", F.coalesce("component", "sid").alias("c"))
    placed = common.written(placed, "classes")
    whole = placed.groupBy("c").agg(F.min("m").alias("component_id"))
    # a class that very many copies have meets them by a broadcast
    named = common.written(placed.join(whole, "c").select("sid", "component_id", "rows"), "named")
    found = common.counted_join(indexed.where("sid is not null"), named, ["sid"], "rows").select("doc_id", F.col("n").alias("n_shingles"), "sid", "component_id")
    return found.unionByName(indexed.where("sid is null").select("doc_id", F.col("n").alias("n_shingles"), "sid", F.col("doc_id").alias("component_id")))


def unique_documents(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """docs with one row of each component: the one that names it. All columns stay."""
    names = docs.columns
    keep = [f"__c{i}" for i in range(len(names))]
    found = near_duplicates(docs.select("doc_id", "text"), k, num, den)
    groups = found.where("sid is not null").groupBy("sid").agg(F.first("component_id").alias("first"), F.count("*").alias("n"), F.min("doc_id").alias("least"))
    groups = common.written(groups.where((F.col("n") > 1) | ~F.col("first").eqNullSafe(F.col("least"))).select("sid", "first", "n"), "groups")
    limit = max(1, (groups.agg(F.sum("n")).first()[0] or 0) // common.SHARES)
    # at most SHARES of them: each has more than one in SHARES of all rows in groups
    many = F.broadcast(groups.where(F.col("n") > limit).select(F.col("sid").alias("__m"), F.col("first").alias("__f")))
    few = groups.where(F.col("n") <= limit).select(F.col("sid").alias("__g"), "first").hint("merge")
    text = keep[names.index("text")]
    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(keep, docs.schema.fields, strict=True)], T.StructField("__sid", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("words", _words.clear)
        for batch in common.sliced(batches, 2 << 20, name=text, release=_words.clear):
            sids = [set_id(shingles(t, k)) for t in batch.column(keep.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sids, pa.int64())], names=[*keep, "__sid"])

    own = F.col(keep[names.index("doc_id")]).cast("long")
    # copies of large classes go before anything is shuffled
    rows = docs.toDF(*keep).mapInArrow(run, schema).join(many, F.col("__sid") == F.col("__m"), "left")
    rows = rows.where(F.col("__m").isNull() | own.eqNullSafe(F.col("__f"))).drop("__f")
    rows = rows.join(few, F.col("__sid") == F.col("__g"), "left")
    rows = common.written(rows.where(F.col("__g").isNull() | own.eqNullSafe(F.col("first"))), "unique")
    alone = rows.where("__g is null and __m is null").select(keep)
    chosen = rows.where("__g is not null or __m is not null").dropDuplicates(["__sid"]).select(keep)
    return alone.unionByName(chosen).toDF(*names)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of `documents` whose sets of three-word shingles have a similarity of 0.9."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), k=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")
