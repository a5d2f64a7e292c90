"""Substring deduplication by hashing the sentences of lines, and paragraphs of them.

A unit is a sentence or the rest of a line: it ends after sentence marks or line feeds, and the units
tile the text. Units are normalised (case and everything but letters and digits are ignored) and
digested to 128 bits, units without words left out. Digests meet globally; of each digest that occurs
more than once the occurrence of least rank (doc_id, then place in the text) is the one to keep.

A paragraph is a run of neighbouring repeated units of MIN_WORDS words or more in all; repeats in
shorter runs (greetings, headings, stock phrases) always stay. A run of occurrences that are not the
ones to keep is removed, with what stands between its units. Offsets of what is removed refer to the
original text, in code points.

A digest that very many units share is found on a sample and goes another way: its first occurrence is
aggregated before the shuffle and sent to the units, so that no task gets all of them. Which way a
digest goes does not change the result.

Defined results: null texts stay null and have no units; empty texts stay empty; null doc_ids rank
last; rows with equal doc_id and text are one document that is stored twice: each gets the same
result and neither repeats the other; rows with equal doc_id and other texts rank by a hash of the
text; a unit that repeats within a document counts as repeated, but its first occurrence stays; empty
tables give no rows; other columns are ignored; texts of any length are read whole; text without
sentence marks and line feeds is one unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Words in a run of repeated units that count as a paragraph: half of a passage of fifty.
MIN_WORDS = 25
UNIT = re.compile(r"[^.!?。！？\n]*[.!?。！？\n]+|[^.!?。！？\n]+")
WORD = re.compile(r"[^\W_]+")
LAST = (1 << 63) - 1
#: One unit in SAMPLE decides what is hot: digests with more than one in HOT of the sampled units, so
#: that HOT of them are sent to every task at most. So rare ones as have under LEAST sampled units never are.
SAMPLE, HOT, LEAST = 64, 2000, 16
PLACE = ("rank", "tie", "unit")


def units_of(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each unit that has words."""
    for m in UNIT.finditer(text):
        words = WORD.findall(m.group().lower())
        if words:
            yield m.start(), m.end(), words


def digest(words: list[str]) -> tuple[int, int]:
    """128 bits of a normalised unit as two signed integers."""
    h = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, rank (doc_id, nulls last) and tie (of the text)."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(LAST)).alias("rank"), F.xxhash64(text).alias("tie"))


def units(rows: DataFrame) -> DataFrame:
    """rank, tie, unit (its number among those with words), words (how many), and its digest."""
    schema = "rank long, tie long, unit int, words int, h1 long, h2 long"
    out_schema = common.fields(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("lines", lambda: None)
        for batch in common.sliced(batches, 2 << 20):
            columns: list[list[int]] = [[] for _ in out_schema]
            for text, rank, tie in zip(common.texts_of(batch), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for k, (_, _, words) in enumerate(units_of(text)):
                    for column, x in zip(columns, (rank, tie, k, len(words), *digest(words)), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)

    return rows.select("text", "rank", "tie").mapInArrow(run, schema)


def repeats(found: DataFrame) -> DataFrame:
    """rank, tie, unit, words, again (it is not the occurrence to keep) of units that occur elsewhere."""
    digests = ["h1", "h2"]
    sampled = found.where(F.pmod(F.xxhash64(*PLACE), F.lit(SAMPLE)) == 0)
    total = sampled.count()
    # at most HOT rows by construction: each has more than one in HOT of the sampled units
    hot = common.written(sampled.groupBy(digests).agg(F.count("*").alias("n")).where(F.col("n") > F.lit(max(LEAST, total // HOT))).select(digests), "hot", few=True)
    place, every = F.struct(*PLACE), Window.partitionBy(digests)
    cold = found.join(F.broadcast(hot), digests, "left_anti")
    cold = cold.withColumns({"first": F.min(place).over(every), "last": F.max(place).over(every)})
    heads = found.join(F.broadcast(hot), digests).groupBy(digests).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    both = cold.unionByName(found.join(F.broadcast(common.written(heads, "heads", few=True)), digests))
    return both.where(F.col("first") != F.col("last")).select(*PLACE, "words", (place != F.col("first")).alias("again"))


def runs(numbers: list[int], words: list[int], least: int) -> list[tuple[int, int]]:
    """First and last of each run of neighbouring numbers (ascending) that has `least` words."""
    out, size = [], 0
    for i, k in enumerate(numbers):
        if i and numbers[i - 1] == k - 1:
            size += words[i]
        else:
            size, first = words[i], k
        if size >= least:
            if out and out[-1][0] == first:
                out[-1] = (first, k)
            else:
                out.append((first, k))
    return out


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without repeated paragraphs, n_repeated (units in paragraphs that occur elsewhere
    too, the occurrences to keep among them), n_removed (units removed), n_units, and removed
    (start:end of each removed run in the original text, in order, comma-joined)."""
    rows = _rows(docs)
    marks = repeats(common.written(units(rows), "units"))
    lists = marks.groupBy(F.col("rank").alias("__rank"), F.col("tie").alias("__tie")).agg(F.collect_set(F.struct("unit", "words", "again")).alias("marks"))
    schema = "doc_id long, text string, n_repeated long, n_removed long, n_units long, removed string"
    out_schema = common.fields(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("lines", lambda: None)
        for batch in common.sliced(batches, 2 << 20):
            out: list[list] = [[] for _ in range(5)]
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = sorted((m["unit"], m["words"], m["again"]) for m in found or [])
                spans = [(a, b) for a, b, _ in units_of(text)] if text else []
                repeated = runs([u for u, _, _ in found], [w for _, w, _ in found], min_words)
                gone = runs([u for u, _, x in found if x], [w for _, w, x in found if x], min_words)
                cuts = [(spans[a][0], spans[b][1]) for a, b in gone]
                kept, at = [], 0
                for a, b in cuts:
                    kept.append(text[at:a])
                    at = b
                text = "".join([*kept, text[at:]]) if cuts else text
                counts = (sum(b - a + 1 for a, b in x) for x in (repeated, gone))
                for column, x in zip(out, (text, *counts, len(spans), ",".join(f"{a}:{b}" for a, b in cuts)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, f.type) for c, f in zip(out, list(out_schema)[1:], strict=True)]], schema=out_schema)

    # always by a shuffle: lists grow with the corpus
    joined = rows.join(lists.hint("merge"), (F.col("rank") == F.col("__rank")) & (F.col("tie") == F.col("__tie")), "left")
    return joined.select("doc_id", "text", "marks").mapInArrow(run, schema)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` without paragraphs that earlier units repeat."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH pieces AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^.!?。！？\n]*[.!?。！？\n]+|[^.!?。！？\n]+') AS p FROM documents
), tiles AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM pieces
), placed AS (
  SELECT doc_id, k, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS b,
         regexp_extract_all(lower(piece), '[\p{L}\p{N}]+') AS w FROM tiles
), units AS (
  SELECT doc_id, b - length(piece) AS a, b, len(w) AS words, array_to_string(w, ' ') AS norm,
         row_number() OVER (PARTITION BY doc_id ORDER BY k) AS u FROM placed WHERE len(w) > 0
), marked AS (
  SELECT *, count(*) OVER (PARTITION BY norm) > 1 AS again_or_first, row_number() OVER (PARTITION BY norm ORDER BY doc_id, u) > 1 AS again FROM units
), grouped AS (
  SELECT *, u - row_number() OVER (PARTITION BY doc_id, again_or_first ORDER BY u) AS g1,
         u - row_number() OVER (PARTITION BY doc_id, again ORDER BY u) AS g2 FROM marked
), sized AS (
  SELECT *, again_or_first AND sum(words) OVER (PARTITION BY doc_id, again_or_first, g1) >= 25 AS repeated,
         again AND sum(words) OVER (PARTITION BY doc_id, again, g2) >= 25 AS gone FROM grouped
), counted AS (
  SELECT doc_id, count_if(repeated)::BIGINT AS n_repeated, count_if(gone)::BIGINT AS n_removed, count(*) AS n_units FROM sized GROUP BY doc_id
), spans AS (
  SELECT doc_id, min(a)::BIGINT AS a, max(b)::BIGINT AS b FROM sized WHERE gone GROUP BY doc_id, g2
), bounds AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM spans
), cut AS (
  SELECT doc_id, string_agg(substr(text, from_ + 1, a - from_), '' ORDER BY a) AS before, max(b) AS last,
         string_agg(a::VARCHAR || ':' || b::VARCHAR, ',' ORDER BY a) AS removed
  FROM bounds JOIN documents USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN c.doc_id IS NULL THEN d.text ELSE c.before || substr(d.text, c.last + 1) END AS text,
       coalesce(n.n_repeated, 0) AS n_repeated, coalesce(n.n_removed, 0) AS n_removed, coalesce(n.n_units, 0) AS n_units, coalesce(c.removed, '') AS removed
FROM documents d LEFT JOIN counted n USING (doc_id) LEFT JOIN cut c USING (doc_id)
"""
