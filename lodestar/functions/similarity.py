"""String similarity that Spark has no function for: Ratcliff-Obershelp ratio and NFKC."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """SequenceMatcher's ratio, arguments in this order, with its defaults (it is not symmetric).
    Rows that share b reuse its index."""
    matcher, last = SequenceMatcher(None), None
    out = []
    for x, y in zip(a, b, strict=True):
        if x is None or y is None:
            out.append(None)
            continue
        if y != last:
            matcher.set_seq2(y)
            last = y
        matcher.set_seq1(x)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.StringType())
def nfkc(c: pd.Series) -> pd.Series:
    return c.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def best_possible(a: Column, b: Column) -> Column:
    """The highest ratio that two lengths allow."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.least(F.length(a), F.length(b)) / total)


def bibliography_norm(c: Column) -> Column:
    """NFKC, lower case, no trailing dots, ASCII letters and digits. Apply nfkc only to texts that
    need it: see with_bibliography_norm."""
    t = F.regexp_replace(F.trim(F.lower(F.coalesce(c, F.lit("")))), r"[.\s]+$", "")
    return F.trim(F.regexp_replace(t, "[^0-9a-z]+", " "))


def with_bibliography_norm(df, column: str, out: str):
    """df with `out`, the normalised column; only rows with non-ASCII texts pass through Python."""
    needs = F.coalesce(F.col(column).rlike(r"[^\x00-\x7F]"), F.lit(False))
    plain = df.where(~needs).withColumn(out, bibliography_norm(F.col(column)))
    other = df.where(needs).withColumn(out, bibliography_norm(nfkc(F.col(column))))
    return plain.unionByName(other)


def title_similarity_inputs(c: Column) -> Column:
    """What the title match compares."""
    return tx.title_norm(F.coalesce(c, F.lit("")))
