"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit for the sign of each component, in m segments of about log2 of as many bits
as there are rows. Rows with equal codes are one class. In round r a query looks up, in each segment's
index, the values at distance r from its own, one segment after another: with each segment the
distance within which every class has been seen grows by one (a class that is farther than r in the
first segments and farther than r - 1 in the others is at least that far in all). A query takes only as
many segments as its k-th verified distance still asks for, and is done when that distance is covered.
Radii grow until all queries are done; there is no scan.

The index is dealt by the last bits of a segment's value, its part. A query is sent to each part within
r of its own, and changes the other bits there: what is looked up is never shuffled or broadcast, and the
tasks hold an index of a counted size. A part that very many classes share is dealt over salts, in
proportion to its share (SHARES).

Defined results: null vectors are neither found nor asked for; null components count as not
positive; shorter vectors have zero bits at their end; a query finds itself and its copies too; ties
go to the smaller id; repeated rows are found once, by their id; an empty table gives no rows; other
columns are ignored, whatever they are called; a table with fewer than k vectors gives as many.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Bits of a segment, at least and at most.
NARROWEST, WIDEST = 4, 24
#: No (segment, part) that one task joins has more than twice the mean, or about this share of the index.
SHARES = 2048
#: Rows of the index that a task holds, about.
HELD = 200_000
K = 10


def segments(bits: int, rows: int) -> list[int]:
    """Widths of the segments: about log2 of the rows each, as even as they get."""
    width = min(WIDEST, max(NARROWEST, rows.bit_length() - 1))
    m = max(1, -(-bits // width))
    return [bits // m + (i < bits % m) for i in range(m)]


def codes(vectors: DataFrame, widths: list[int], vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and code: an array with a number for each segment."""
    starts = [sum(widths[:i]) for i in range(len(widths))]
    bit = lambda i: F.when(F.coalesce(F.get(F.col(embedding), i), F.lit(0.0)) > 0, 1).otherwise(0)
    whole = F.array(*[F.aggregate(F.sequence(F.lit(a), F.lit(a + n - 1)), F.lit(0), lambda x, i: x * 2 + bit(i)) for a, n in zip(starts, widths, strict=True)])
    return vectors.where(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), whole.alias("code"))


def distance(a: Column, b: Column, m: int) -> Column:
    return sum((F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(m)), F.lit(0))


def masks(width: int, radius: int) -> list[int]:
    """All changes of a segment in exactly radius bits."""
    return [sum(1 << b for b in c) for c in combinations(range(width), radius)]


def _listed(numbers: list[int]) -> Column:
    """One string literal, which Spark folds to an array, however many numbers there are."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")


def _changes(widths: list[int], radius: int) -> Column:
    """The masks of the columns segment and left, which is radius at most: all changes in exactly left
    bits. At most two widths differ."""
    out = F.array().cast("array<int>")
    for w in sorted(set(widths)):
        here = F.col("segment").isin([i for i, x in enumerate(widths) if x == w])
        for left in range(min(w, radius) + 1):
            out = F.when(here & (F.col("left") == left), _listed(masks(w, left))).otherwise(out)
    return out


def parted(rows: int, widths: list[int], tasks: int) -> tuple[int, int]:
    """Bits of a part, and in how many tasks the index of so many rows is held: `tasks` at least, 8 parts for
    each where segments are wide enough."""
    tasks = max(tasks, -(-rows // HELD))
    return min(min(widths), (8 * tasks // len(widths)).bit_length()), tasks


@contextmanager
def _dealt_once(spark: SparkSession) -> Iterator[None]:
    """For what is planned within: a join takes sides that are dealt alike by some of its keys as they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest (distance, id) of each query."""
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(base: DataFrame, queries: DataFrame, widths: list[int], k: int = K) -> DataFrame:
    """query_id, rank (from 1), neighbor_id, distance; base and queries have id and code."""
    m = len(widths)
    base = base.groupBy("id").agg(F.min("code").alias("code"))
    # of a class only its k smallest ids can be an answer; Spark drops the rest before it shuffles
    heads = base.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k)
    members = common.written(heads.select("code", "id"), "members")
    index = members.select("code").distinct().select("code", F.posexplode("code").alias("segment", "value"))
    index = common.written(index, "segments")
    rows = index.count()
    bits, tasks = parted(rows, widths, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = lambda c: F.col(c).bitwiseAND(F.lit((1 << bits) - 1))
    limit = max(1, rows // SHARES, 2 * rows // (m << bits))
    many = index.groupBy("segment", part("value").alias("part")).agg(F.ceil(F.count("*") / limit).cast("int").alias("salts")).where("salts > 1")
    # a part of each segment at most, and each of them has more than one in SHARES of all rows
    many = F.broadcast(common.written(many, "many", few=True))
    index = index.select("code", "segment", part("value").alias("part"), F.shiftright("value", bits).alias("rest")).join(many, ["segment", "part"], "left")
    index = index.withColumn("salt", F.pmod(F.xxhash64("code"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    far = sum(widths)
    open_ = queries.groupBy("id").agg(F.min("code").alias("q")).select(F.col("id").alias("query_id"), "q", F.lit(far).alias("worst"))
    open_ = common.written(open_, "queries")
    answers = best = None
    for r in range(max(widths) + 1):
        # what is asked of this round: the segments that the k-th distance so far still needs
        asked = open_.select("query_id", "q", "worst", F.posexplode("q").alias("segment", "own")).where(F.col("segment") + m * r <= F.col("worst"))
        asked = asked.withColumn("change", F.explode(_listed([x for n in range(min(r, bits) + 1) for x in masks(bits, n)])))
        asked = asked.withColumns({"part": part("own").bitwiseXOR(F.col("change")), "own": F.shiftright("own", bits), "left": F.lit(r) - F.bit_count("change")})
        asked = asked.join(many, ["segment", "part"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("change", "salts")
        probes = asked.repartition(tasks, "segment", "part", "salt").withColumn("change", F.explode(_changes([w - bits for w in widths], r)))
        probes = probes.withColumn("rest", F.col("own").bitwiseXOR(F.col("change")))
        # both sides are dealt alike already, see _dealt_once. Verified within the join: only what is no farther than the
        # k-th so far comes out. Spark takes what is exploded for small, so each join says how it is made
        dealt = index.repartition(tasks, "segment", "part", "salt").hint("shuffle_hash")
        apart = distance(F.col("q"), F.col("code"), m)
        met = probes.join(dealt, ["segment", "part", "salt", "rest"]).where(apart <= F.col("worst"))
        near = met.select("query_id", "code", apart.alias("distance")).distinct()
        found = near.join(members.hint("merge"), "code").select("query_id", "id", "distance")
        if best is not None:
            found = found.unionByName(best.select("query_id", "id", "distance")).distinct()
        with _dealt_once(base.sparkSession):
            best = common.written(_best(found, k), "best")
        state = best.groupBy("query_id").agg(F.count("*").alias("n"), F.max("distance").alias("d"))
        state = open_.join(state.hint("merge"), "query_id", "left").withColumn("covered", F.least(F.col("worst"), F.lit(m * (r + 1) - 1)))
        # after the last radius every class has been seen
        state = state.withColumn("done", (F.col("n") >= k) & (F.col("d") <= F.col("covered")) if r < max(widths) else F.lit(True))
        state = common.written(state.select("query_id", "q", F.when(F.col("n") >= k, F.col("d")).otherwise(F.lit(far)).alias("worst"), F.coalesce("done", F.lit(False)).alias("done")), "queries")
        closed = best.join(state.where("done").select("query_id").hint("merge"), "query_id", "left_semi")
        answers = closed if answers is None else answers.unionByName(closed)
        open_ = state.where(~F.col("done")).drop("done")
        if open_.isEmpty():
            break
        best = best.join(open_.select("query_id").hint("merge"), "query_id", "left_semi")
    return answers.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("neighbor_id"), F.col("distance").cast("long").alias("distance"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest codes in `embeddings` of every row whose id is divisible by 100."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    bits, rows = vectors.agg(F.max(F.size("embedding")), F.count("embedding")).first()
    widths = segments(max(1, bits or 1), rows)
    base = common.written(codes(vectors, widths), "vectors")
    return top_k(base, base.where(F.col("id") % 100 == 0), widths)


OP6_SQL = """
WITH bits AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS neighbor_id,
         CAST(list_sum(list_transform(list_zip(q.b, d.b), lambda p: CASE WHEN p[1] != p[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
  FROM bits q, bits d WHERE q.vec_id % 100 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""
