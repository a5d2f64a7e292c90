"""Key-value caches as tables: valid rows, latest wins, misses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

TTL_DAYS, VERSION = 180, 2
SECRET_NAMES = r"(?i)key|token|secret|password"


def lookup_key(columns: dict[str, Column]) -> Column:
    """A key of named values, whatever their order."""
    return F.to_json(F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in sorted(columns.items())]))


def author_key(name: Column, affiliation: Column, institutions: Column, settings: Column) -> Column:
    return lookup_key({"name": tx.plain_norm(name), "affiliation": tx.plain_norm(affiliation), "institutions": tx.plain_norm(institutions), "settings": settings})


def valid(cache: DataFrame, now: float, ttl_days: int = TTL_DAYS, version: int = VERSION) -> DataFrame:
    """Entries with a number for a timestamp, of this version and not too old; `now` is a parameter."""
    at = F.col("timestamp").cast("string").try_cast("double")
    return cache.where(at.isNotNull() & (F.lit(now) - at <= ttl_days * 86400) & (F.col("version") == version))


def latest(entries: DataFrame, key: str, at: str) -> DataFrame:
    """Of each key the entry with the latest `at`: one aggregation, rows travel once."""
    rest = [c for c in entries.columns if c != key]
    return entries.groupBy(key).agg(F.max_by(F.struct(*rest), at).alias("r")).select(key, "r.*")


def stored(cache: DataFrame, new: DataFrame, key: str, at: str) -> DataFrame:
    """cache with new entries; those with an error stay out."""
    good = new.where(F.col("error").isNull()) if "error" in new.columns else new
    return latest(cache.unionByName(good.select(*[c for c in cache.columns if c in good.columns]), allowMissingColumns=True), key, at)


def merged_fields(cache: DataFrame, new: DataFrame, key: str, at: str) -> DataFrame:
    """cache with the fields that new entries fill; others keep what they had."""
    both = cache.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c not in (key, "__o")]
    return both.groupBy(key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("__o", F.col(at)))).alias(c) for c in columns])


def with_hits(lookups: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lookups that the cache answers, and those it does not."""
    return lookups.join(cache, "key"), lookups.join(cache.select("key"), "key", "left_anti")


def masked(settings: Column) -> Column:
    """A map of settings whose secrets show four characters at most."""
    hide = lambda v: F.when(F.length(v) <= 8, "***").otherwise(F.concat(F.left(v, F.lit(4)), F.lit("***")))
    return F.transform_values(settings, lambda k, v: F.when(k.rlike(SECRET_NAMES), hide(v)).otherwise(v))


def debug_filename(name: Column, payload: Column) -> Column:
    return F.concat(tx.slug(name), F.lit("_"), F.left(F.sha1(payload.cast("binary")), F.lit(10)), F.lit(".json"))
