"""The driver's tables in the shape of citation data, so that operators can be run at any scale.

An order is a work, its line items are its authors, suppliers are the author dimension (their
balance gives an h-index), priorities are cited targets; documents are papers' texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.works import INSTITUTION
from ..session import table


def works(spark: SparkSession, sf: str) -> DataFrame:
    """orders and lineitem as works with authors; h_index is unknown until enriched."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    none = F.lit(None).cast("string")
    author = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_suppkey").cast("string").alias("author_id"), F.concat(F.lit("Supplier, No. "), F.col("l_suppkey").cast("string")).alias("name"), none.alias("orcid"),
        F.when(F.col("l_linenumber") == 1, "first").otherwise("middle").alias("author_position"), F.lit(False).alias("is_corresponding"),
        F.array(F.struct(none.alias("id"), F.concat(F.lit("Institute "), (F.col("l_suppkey") % 7).cast("string")).alias("display_name"), none.alias("ror"), none.alias("country_code"))).cast(f"array<{INSTITUTION}>").alias("institutions"),
        F.lit(None).cast("int").alias("h_index"), none.alias("affiliation"),
    )
    authors = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(author)).alias("l"))
    slim = F.transform("l", lambda a: F.struct(*[a[c].alias(c) for c in ("author_id", "name", "orcid", "author_position", "is_corresponding", "institutions", "h_index", "affiliation")]))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("paper_id"), F.concat(F.col("o_orderpriority"), F.lit(" work "), (F.col("o_orderkey") % 1000).cast("string")).alias("paper_title"), F.year("o_orderdate").alias("year"), F.floor("o_totalprice").cast("int").alias("cited_by_count"), F.col("o_orderkey").alias("ord"))
    joined = orders.join(authors, orders["ord"] == authors["l_orderkey"], "left")
    return joined.select("paper_id", "paper_title", "year", "cited_by_count", "ord", F.coalesce(slim, F.array()).alias("authors"))


def citations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("citing_id"), F.col("o_orderpriority").alias("cited_id"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers whose key is no multiple of 9; the others stay unknown."""
    s = table(spark, sf, "supplier").where(F.col("s_suppkey") % 9 != 0)
    return s.select(F.col("s_suppkey").cast("string").alias("author_id"), F.floor(F.col("s_acctbal") / 100).cast("int").alias("h_index"))


#: The same in DuckDB: w (works), a (authors in order with h and whether known).
SQL = """
w AS (SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, o_orderkey AS ord, o_orderpriority || ' work ' || (o_orderkey % 1000) AS paper_title, o_orderpriority AS cited_id,
             year(o_orderdate)::INT AS year, floor(o_totalprice)::INT AS cited_by_count FROM orders),
m AS (SELECT s_suppkey, floor(s_acctbal / 100)::INT AS h FROM supplier WHERE s_suppkey % 9 != 0),
a AS (SELECT CAST(l_orderkey AS VARCHAR) AS paper_id, l_orderkey AS ord, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR)) - 1 AS pos, l_linenumber,
             CAST(l_suppkey AS VARCHAR) AS author_id, 'Supplier, No. ' || l_suppkey AS name, m.h, m.s_suppkey IS NOT NULL AS known, l_suppkey
      FROM lineitem LEFT JOIN m ON l_suppkey = m.s_suppkey),
best AS (SELECT paper_id, arg_min(author_id, row(-coalesce(h, 0), pos)) AS best_author, max(coalesce(h, 0)) AS max_h FROM a GROUP BY paper_id)
"""


def contexts(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as citation contexts with stand-in scores; every 11th has an error."""
    from ..functions import text as tx

    rows = table(spark, sf, "conversations")
    title = F.concat(F.lit("paper "), F.col("conv_id").cast("string"))
    return rows.select(
        F.col("conv_id").alias("paper_id"), F.col("turn").cast("long").alias("ctx_pos"), title.alias("target_title"), F.col("text").alias("context"), F.col("role").alias("match_text"),
        F.when(F.length("text") % 7 != 0, tx.mock_score(title, F.col("text"))).alias("remark_score"), F.col("role").alias("reason"), F.when(F.col("turn") % 11 == 1, F.lit("late")).alias("remark_error"),
    )


CONTEXTS_SQL = """
c AS (SELECT conv_id AS paper_id, turn AS ctx_pos, text AS context, role,
             CASE WHEN length(text) % 7 != 0 THEN ('0x' || substr(md5('paper ' || conv_id || '|' || text), 1, 2))::INT % 11 END AS s, CASE WHEN turn % 11 = 1 THEN 'late' END AS err FROM conversations)
"""


def cited_texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents as papers: numeric citations set in, and a bibliography of numbered entries."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    n = lambda x: (F.col("doc_id") % x).cast("string")
    body = F.concat(F.lit("Intro ["), n(9), F.lit("; 12-15] says. "), F.col("text"), F.lit("\nLater [3, "), n(5), F.lit("] and [20"), F.lit("-"), F.lit("16].\n"))
    refs = F.concat(F.lit("\n[1] Aa B. Old title "), n(13), F.lit(". 1999.\n[2] Cc D. New title "), n(17), F.lit(". 2004b.\n[3] Ee F. Last one. 2011.\n"))
    return d.select("doc_id", body.alias("body"), F.concat(body, F.lit("## References\n"), refs).alias("text"), refs.alias("refs"))


CITED_SQL = """
p AS (SELECT doc_id, 'Intro [' || (doc_id % 9) || '; 12-15] says. ' || text || chr(10) || 'Later [3, ' || (doc_id % 5) || '] and [20-16].' || chr(10) AS body FROM documents WHERE text IS NOT NULL)
"""
