"""Queries of lookups, candidate pages and PDF links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web
from ..operators import caches, honors, pdf, references
from ..session import cut, table
from ..sources import tables
from .matching import TITLE_NORM, _text
from .registry import longs, query


def none() -> Column:
    return F.lit(None).cast("string")


@query(rf"""
WITH q AS (SELECT list_distinct(string_split({TITLE_NORM.format("'The, of haan ing'")}, ' ')) AS q),
d AS (SELECT doc_id, list_distinct(string_split({TITLE_NORM.format("left(text, 200)")}, ' ')) AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id FROM (SELECT doc_id, len(list_intersect(w, q)) AS s FROM d, q) WHERE s > 0 ORDER BY s DESC, doc_id LIMIT 25""")
def src01_by_title(spark: SparkSession, sf: str) -> DataFrame:
    """SRC01, SRC06: the works whose titles share most words with a title."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", F.left("text", F.lit(200)).alias("title"))
    return tables.by_title(d, "The, of haan ing", 25, "title", "doc_id").select("doc_id")


@query(r"""
WITH p AS (SELECT page_id, lower(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS plain FROM pages),
h AS (SELECT page_id, len(list_filter(['thatthe', 'haan', 'and', 'tion'], lambda t: contains(plain, t))) AS hits FROM p)
SELECT page_id, hits >= 3 AND hits / 4 >= 0.6 AS relevant FROM h""")
def flt10_page_relevance(spark: SparkSession, sf: str) -> DataFrame:
    """FLT10: pages that are about a query, by their text without tags."""
    return table(spark, sf, "pages").select("page_id", web.page_relevant(F.col("html"), F.lit("thatthe: haan AND tion of it pdf")).alias("relevant"))


@query("""
WITH r AS (SELECT s_suppkey::VARCHAR AS k, unnest([0, 1, 3, 4]) AS r FROM supplier),
x AS (SELECT k, CASE r WHEN 0 THEN 'http://cs.u' || k || '.edu/~ann' WHEN 1 THEN 'https://en.wikipedia.org/wiki/Ann' WHEN 3 THEN 'http://u' || k || '.org/people/ann/lee/x' ELSE 'http://u' || k || '.org/z' END AS url,
  CASE r WHEN 0 THEN 36 WHEN 1 THEN -16 WHEN 3 THEN 36 ELSE 20 END AS score, CASE r WHEN 0 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 4 END AS place FROM r)
SELECT k AS author_key, url, score::BIGINT AS score, place::BIGINT AS place, place > 2 AS forced FROM x WHERE place IN (1, 2, 4)""")
def srt07_candidate_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRT07, EXT13, EXT14, TXT24, FLT11, FLT12: candidate pages of each author, scored, ordered and cut;
    the best page of Wikipedia stays."""
    k = F.col("s_suppkey")
    result = lambda rank, title, *url: F.struct(F.lit(rank).alias("rank"), F.lit(title).alias("title"), _text(*url).alias("url"))
    found = F.array(
        result(4, "Ann page", "http://cs.u", k, ".edu/~ann#top"), result(1, "Wiki", "https://en.wikipedia.org/wiki/Ann"), result(2, "Digital library", "https://dl.acm.org/ann"), result(3, "Lee", "http://u", k, ".org/people/ann/lee/x"),
        result(0, "Other", "http://u", k, ".org/z"), result(5, "Again", "http://cs.u", k, ".edu/~ann"), result(6, "A file", "ftp://u.edu/ann"), result(7, "A PDF", "http://u.edu/ann.pdf"),
    )
    rows = table(spark, sf, "supplier").select(k.cast("string").alias("author_key"), F.lit("Ann Lee").alias("name"), F.explode(found).alias("r")).select("author_key", "name", "r.*")
    return longs(honors.candidate_pages(rows, True, 2).select("author_key", "url", "score", "place", "forced"))


@query("""
WITH p AS (SELECT p_partkey, 'http://h' || (p_partkey % 100) || '.org/a/b.html' AS url, p_partkey % 100 AS n FROM part WHERE p_partkey < 100 OR p_partkey % 100 = p_partkey),
l AS (SELECT url, n, unnest([0, 2, 4]) AS pos FROM (SELECT DISTINCT url, n FROM p))
SELECT url, pos::BIGINT AS pos, 'http://h' || n || CASE pos WHEN 0 THEN '.org/f/x.pdf' WHEN 2 THEN '.org/a/get?type=pdf' ELSE '.org/a/y.PDF' END AS link FROM l""")
def ext08_page_links(spark: SparkSession, sf: str) -> DataFrame:
    """EXT08, TXT21: PDF-like links of pages, absolute, without repeats."""
    n = F.col("p_partkey") % 100
    html = _text('<a href="/f/x.pdf">x</a><a href="other.html">o</a><img src="get?type=pdf"><meta content="y.PDF"><a href="http://h', n, '.org/f/x.pdf">x</a>')
    pages = table(spark, sf, "part").select(_text("http://h", n, ".org/a/b.html").alias("url"), html.alias("html")).distinct()
    return longs(pdf.page_links(pages))


RESOLVED_SQL = """
WITH p AS (SELECT p_partkey AS k, unnest(range(6)) AS rank FROM part),
r AS (SELECT k, rank, CASE rank WHEN 0 THEN 'https://arxiv.org/pdf/1.' || k || '.pdf' WHEN 1 THEN 'http://a.org/' || k || '.pdf' WHEN 2 THEN CASE WHEN k % 2 = 0 THEN 'https://openreview.net/pdf?id=f' || k END
  WHEN 3 THEN 'http://site' || k || '.org/files/great-title-study.pdf' WHEN 4 THEN NULL ELSE 'https://openreview.net/pdf?id=g' || k END AS pdf_url,
  CASE rank WHEN 0 THEN 'arxiv' WHEN 1 THEN 'direct' WHEN 2 THEN CASE WHEN k % 2 = 0 THEN 'openreview' END WHEN 3 THEN 'page' WHEN 5 THEN 'openreview' END AS found_by FROM p)
"""


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Six results for each part: of arXiv, direct, a forum, a page with a good link, one without, a PDF
    of a forum."""
    k = F.col("p_partkey")
    result = lambda rank, title, *url: F.struct(F.lit(rank).alias("rank"), F.lit(title).alias("title"), _text(*url).alias("url"))
    found = F.array(
        result(0, "unrelated", "https://arxiv.org/abs/1.", k), result(1, "great title study", "http://a.org/", k, ".pdf"), result(2, "great title study", "https://openreview.net/forum?id=f", k),
        result(3, "great title", "http://site", k, ".org/page"), result(4, "nothing", "http://none", k, ".org/page"), result(5, "great title study", "https://openreview.net/pdf?id=g", k),
    )
    results = table(spark, sf, "part").select(_text("great title study ", k).alias("query"), F.explode(found).alias("r")).select("query", "r.*")
    about = F.when(k % 2 == 0, _text("<p>great title study ", k, "</p>")).otherwise("<p>else</p>")
    pages = F.array(
        F.struct(_text("https://openreview.net/forum?id=f", k).alias("url"), about.alias("html")),
        F.struct(_text("http://site", k, ".org/page").alias("url"), F.lit("<p>" + "far " * 300 + '</p><a href="files/poor.pdf">p</a><a href="files/great-title-study.pdf">g</a>').alias("html")),
        F.struct(_text("http://none", k, ".org/page").alias("url"), F.lit('<a href="files/poor.pdf">p</a>').alias("html")),
    )
    return pdf.resolved(results, table(spark, sf, "part").select(F.explode(pages).alias("p")).select("p.*"))


@query(f"{RESOLVED_SQL} SELECT 'great title study ' || k AS query, rank, pdf_url, found_by FROM r")
def ext09_resolved_pdfs(spark: SparkSession, sf: str) -> DataFrame:
    """EXT09, JOI12, TXT22: where the PDF of each result is, and how it was found."""
    return longs(_resolved(spark, sf).select("query", "rank", "pdf_url", "found_by"))


@query(f"""{RESOLVED_SQL}, u AS (SELECT k, rank, pdf_url FROM r WHERE pdf_url IS NOT NULL AND rank IN (1, 2, 5) AND k % (rank + 2) = 0)
SELECT 'great title study ' || k AS query, min(rank) AS rank, arg_min(pdf_url, rank) AS pdf_url FROM u GROUP BY k""")
def ext10_first_usable(spark: SparkSession, sf: str) -> DataFrame:
    """EXT10, FLT14, FLT09: the first relevant result of each query whose PDF could be had."""
    found = cut(_resolved(spark, sf))
    k = F.regexp_extract("query", r"(\d+)$", 1).cast("long")
    downloads = found.where(F.col("pdf_url").isNotNull()).select("pdf_url", (k % (F.col("rank") + 2) == 0).alias("ok"))
    return longs(pdf.first_usable(found, downloads).select("query", "rank", "pdf_url"))


@query(r"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '/cache/' || c_custkey ELSE '/pdfs/' || c_custkey || '_' || trim(regexp_replace(c_name, '[^\w.-]+', '_', 'g'), '_') || '.pdf' END AS pdf_path, c_custkey % 3 <= 1 AS from_cache FROM customer""")
def joi12_cached_paths(spark: SparkSession, sf: str) -> DataFrame:
    """JOI12, TXT12: the file of a paper, by the cache or as it is to be expected; a blank entry has none."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select("c_custkey", k.cast("string").alias("paper_id"), F.col("c_name").alias("paper_title"))
    cache = c.where(k % 3 <= 1).select("paper_id", F.when(k % 3 == 0, _text("/cache/", k)).otherwise(" ").alias("path"))
    return pdf.cached_paths(c, cache, "/pdfs/").select("c_custkey", "pdf_path", "from_cache")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Unknown' END AS honor, CASE event_id % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS status,
  CASE event_id % 3 WHEN 0 THEN 'http://a' WHEN 1 THEN 'http://t/' || event_id ELSE '' END AS sources FROM events""")
def llm04_search_replies(spark: SparkSession, sf: str) -> DataFrame:
    """LLM04, TXT33, TXT35, TXT23, PRJ17: statuses and sources of replies in plain text."""
    k = F.col("event_id")
    reply = _text("Findings\nIEEE Fellow: Unknown\n", F.when(k % 4 == 0, "- ACM Fellow: yes, 2001").when(k % 4 == 1, "ACM Fellow - No").when(k % 4 == 2, "ACM Fellow,\nas it stands: Unknown").otherwise("nothing else"), F.when(k % 3 == 1, _text("\n(http://t/", k, ")")).otherwise(""))
    cited = F.when(k % 3 == 0, F.array(F.lit(" http://a "), F.lit(""), F.lit("http://a"))).otherwise(F.array().cast("array<string>"))
    e = table(spark, sf, "events").select("event_id", tx.honor_from_text(reply, "ACM Fellow").alias("honor"), honors.reply_citations(reply, cited).alias("sources"))
    rows = e.select("event_id", "honor", k.alias("author_key"), tx.statuses(none(), F.col("honor"), none()).alias("statuses"), "sources", none().alias("error"))
    done = honors.finalized(rows).select(F.col("author_key").alias("event_id"), F.col("statuses.acm").alias("status"), F.array_join("sources", " ").alias("sources"))
    return e.select("event_id", "honor").join(done, "event_id")


# -- caches and second tries ------------------------------------------------------------------------


@query("""
WITH n AS (SELECT user_id, arg_max(event_id, event_id) AS last FROM events WHERE event_id % 3 != 0 GROUP BY user_id),
o AS (SELECT user_id, max(event_id) AS first FROM events WHERE event_id % 3 = 0 GROUP BY user_id)
SELECT coalesce(n.user_id, o.user_id) AS user_id, greatest(coalesce(n.last, -1), coalesce(o.first, -1)) AS at FROM n FULL JOIN o ON n.user_id = o.user_id""")
def snk10_stored(spark: SparkSession, sf: str) -> DataFrame:
    """SNK10: new entries win over the cache's where they are later; entries with an error stay out."""
    e = table(spark, sf, "events").select("user_id", F.col("event_id").alias("at"))
    cache = e.where(F.col("at") % 3 == 0).groupBy("user_id").agg(F.max("at").alias("at"))
    new = e.where(F.col("at") % 3 != 0).withColumn("error", none())
    bad = e.select("user_id", (F.col("at") + 10**9).alias("at"), F.lit("failed").alias("error"))
    return caches.stored(cache, new.unionByName(bad), "user_id", "at")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_custkey WHEN c_custkey % 5 > 0 THEN 'old' END AS a, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old ' || c_name END AS b FROM customer""")
def snk10_merged_fields(spark: SparkSession, sf: str) -> DataFrame:
    """SNK10: fields that a new entry fills replace the cache's, the others stay."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    cache = c.select(k, F.when(k % 5 > 0, "old").alias("a"), _text("old ", F.col("c_name")).alias("b"), F.lit(5).alias("at"))
    new = c.select(k, F.when(k % 2 == 0, _text("new ", k)).alias("a"), F.when(k % 3 == 0, "new").alias("b"), F.lit(1).alias("at"))
    return caches.merged_fields(cache, new, "c_custkey", "at").select("c_custkey", "a", "b")


@query("SELECT o_orderkey, o_custkey % 2 = 0 AS hit, CASE WHEN o_custkey % 2 = 0 THEN o_custkey * 7 END AS value FROM orders")
def joi11_cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    """JOI11: lookups that a cache answers, and those it does not; keys do not depend on the order of names."""
    key = lambda c: caches.lookup_key({"id": c, "kind": F.lit("order")})
    looked = table(spark, sf, "orders").select("o_orderkey", key(F.col("o_custkey")).alias("key"))
    ids = table(spark, sf, "orders").select("o_custkey").distinct().where(F.col("o_custkey") % 2 == 0)
    cache = ids.select(caches.lookup_key({"kind": F.lit("order"), "id": F.col("o_custkey")}).alias("key"), (F.col("o_custkey") * 7).alias("value"))
    hits, misses = caches.with_hits(looked, cache)
    return hits.select("o_orderkey", F.lit(True).alias("hit"), "value").unionByName(misses.select("o_orderkey", F.lit(False).alias("hit"), F.lit(None).cast("long").alias("value")))


@query("""
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS a, o_orderkey % 3 AS b FROM orders),
r AS (SELECT *, a = 0 AND (b != 0 OR o.b = 0 AND k % 5 = 0) AS second FROM o)
SELECT k AS o_orderkey, CASE WHEN second THEN b ELSE a END AS ref_id, CASE WHEN second THEN 'second' ELSE 'first' END AS told FROM r""")
def set03_second_title(spark: SparkSession, sf: str) -> DataFrame:
    """SET03, EXT07: where the matched title finds no entry, the title asked for is tried."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    first = o.select(k.alias("paper_id"), (k % 4).cast("int").alias("ref_id"), F.lit(0.2).alias("match_score"), F.lit("first").alias("told"))
    second = o.select(k.alias("paper_id"), (k % 3).cast("int").alias("ref_id"), F.when(k % 5 == 0, 0.5).otherwise(0.1).alias("match_score"), F.lit("second").alias("told"))
    return longs(references.with_second_title(first, second).select(F.col("paper_id").alias("o_orderkey"), "ref_id", "told"))


@query("""
WITH m AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Unknown' ELSE 'Yes' END AS l, event_id % 5 = 0 AS failed, event_id % 2 = 0 AS told FROM events)
SELECT event_id, CASE WHEN (failed OR l = 'Unknown') AND told THEN 'No' ELSE l END AS acm, CASE WHEN failed AND NOT told THEN 'e' END AS error FROM m""")
def llm05_dispatched(spark: SparkSession, sf: str) -> DataFrame:
    """LLM05, LLM06: the remote lookup stands in where the local one failed or knows nothing."""
    k = F.col("event_id")
    s = lambda c: F.struct(F.lit("Unknown").alias("ieee"), c.alias("acm"), F.lit("Unknown").alias("aaai"))
    e = table(spark, sf, "events")
    nothing = F.array().cast("array<string>")
    local = e.select(k.alias("author_key"), s(F.when(k % 3 == 0, "Unknown").otherwise("Yes")).alias("statuses"), nothing.alias("sources"), F.when(k % 5 == 0, "e").alias("error"))
    remote = e.where(k % 2 == 0).select(k.alias("author_key"), s(F.lit("No")).alias("statuses"), nothing.alias("sources"), none().alias("error"))
    out = honors.dispatched(local, remote, "local_with_fallback")
    return out.select(F.col("author_key").alias("event_id"), "statuses.acm", "error")
