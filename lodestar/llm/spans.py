"""Spans of a pattern in a text, as a native column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spans(text: Column, pattern: str, around: int = 0) -> Column:
    """array<struct<start, hit, before, after>>, leftmost first, without overlaps. start counts code
    points from 0; before and after are the `around` characters next to the hit.

    The pieces between hits and the hits, by turns, add up to the starts. The pattern is matched from
    left to right once for each of the two, and must not match the empty text."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("g"), h.alias("h"), F.lit(None).cast("string").alias("next")))
    rows = F.transform(rows, lambda x, i: F.struct(F.length(x["g"]).cast("long").alias("n"), x["h"].alias("h"), F.right(x["g"], F.lit(around)).alias("before"), F.coalesce(F.left(F.get(gaps, i + 1), F.lit(around)), F.lit("")).alias("after")) if around else F.struct(F.length(x["g"]).cast("long").alias("n"), x["h"].alias("h")))
    rows = F.filter(rows, lambda x: x["h"].isNotNull())
    kind = "array<struct<start:bigint,hit:string" + (",before:string,after:string" if around else "") + ">>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        own = [(acc["at"] + x["n"]).alias("start"), x["h"].alias("hit")]
        if around:
            own += [x["before"].alias("before"), x["after"].alias("after")]
        return F.struct((acc["at"] + x["n"] + F.length(x["h"])).alias("at"), F.concat(acc["out"], F.array(F.struct(*own))).alias("out"))

    return F.aggregate(rows, start, step, lambda acc: acc["out"])
