"""Scans: works and authors by id, full-text titles, summaries and context files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

CONTEXT = T.ArrayType(T.StructType([T.StructField("context", T.StringType()), T.StructField("context_window_size", T.IntegerType()), T.StructField("remark_score", T.IntegerType()), T.StructField("reason", T.StringType())]))
INSTITUTION = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "display_name", "ror", "country_code")])
FELLOW = T.StructType([T.StructField(c, T.StringType()) for c in ("ieee", "acm", "aaai")])
TOP_AUTHOR = T.StructType([T.StructField("author_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("affiliation", T.StringType()), T.StructField("institutions", T.ArrayType(INSTITUTION)), T.StructField("h_index", T.IntegerType()), T.StructField("fellow_status", FELLOW)])
SUMMARY = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("paper_to_analyze", T.StructType([T.StructField(c, T.StringType()) for c in ("query_title", "matched_title", "paper_id", "target_author")])),
    T.StructField("cited_paper_remarks", T.ArrayType(T.StructType([T.StructField("paper_title", T.StringType()), T.StructField("venue", T.StringType()), T.StructField("has_fellow_topk", T.BooleanType()), T.StructField("reference_entry", T.StringType()), T.StructField("self_citation", T.BooleanType()), T.StructField("topk_authors", T.ArrayType(TOP_AUTHOR)), T.StructField("contexts", CONTEXT)]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def by_id(df: DataFrame, column: str, value: str) -> DataFrame:
    """One row by its id; the filter reaches the scan."""
    return df.where(F.col(column) == value)


def by_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of many ids, each once however often it is asked for; of rows with one id any stays."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi").dropDuplicates([column])


def by_title(df: DataFrame, title: str, k: int = 3, column: str = "paper_title", key: str = "paper_id") -> DataFrame:
    """The k rows whose titles share most words with a title."""
    words = F.array_distinct(F.filter(F.split(tx.title_norm(F.lit(title)), " "), lambda w: w != ""))
    own = F.array_distinct(F.split(tx.title_norm(F.col(column)), " "))
    shared = F.size(F.array_intersect(own, words))
    return df.withColumn("__s", shared).where("__s > 0").orderBy(F.desc("__s"), key).limit(max(0, k)).drop("__s")


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """All **/res/summary.json under a folder, with run_id; unreadable files are left out."""
    raw = spark.read.schema(SUMMARY).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "summary.json").option("mode", "PERMISSIVE").json(folder)
    path = F.input_file_name()
    rows = raw.withColumns({"path": path, "run_id": F.regexp_extract(path, r"([^/]+)/res/summary\.json$", 1)})
    return rows.where((F.col("run_id") != "") & F.col("_corrupt_record").isNull() & F.col("paper_to_analyze").isNotNull()).drop("_corrupt_record").orderBy("path")


def chosen_context_file(files: DataFrame, paper_id: str | None = None) -> DataFrame:
    """Of (path, paper_id, contexts) the file asked for, else the first with contexts, else the first."""
    if paper_id is not None:
        return files.where(F.col("paper_id") == paper_id).limit(1)
    return files.orderBy((F.coalesce(F.size("contexts"), F.lit(0)) > 0).desc(), "path").limit(1)


def without_output(papers: DataFrame, done: DataFrame) -> DataFrame:
    """Papers that have no output yet."""
    return papers.join(done.select("paper_id").distinct(), "paper_id", "left_anti")


def pages_kept(pages: DataFrame, most: int | None) -> DataFrame:
    """A paper's text from its pages (paper_id, pages: array), the first `most`, with what was used."""
    n = F.size("pages")
    used = n if most is None else F.least(n, F.lit(most))
    return pages.select("paper_id", F.array_join(F.slice("pages", F.lit(1), used), "\n\n").alias("text"), n.alias("page_count"), used.alias("pages_used"), (used < n).alias("truncated"))


def search_results(raw: DataFrame, pages: int = 3, per_page: int = 30, most: int = 100) -> DataFrame:
    """Web search results (query, page, pos, title, href): the first pages, at most `most` in order."""
    place = F.row_number().over(Window.partitionBy("query").orderBy("page", "pos"))
    return raw.where((F.col("page") < pages) & (F.col("pos") < per_page)).withColumn("rank", place - 1).where(F.col("rank") < most).select("query", "rank", "title", F.col("href").alias("url"))
