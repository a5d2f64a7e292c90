"""Where a paper's PDF is: search results, pages and link scores. Fetched pages come as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web

LEAST_SCORE = 3


def page_links(pages: DataFrame) -> DataFrame:
    """(url, pos, link): the PDF-like links of pages (url, html), absolute, without repeats. Python
    only joins URLs, and each pair of page and link once."""
    raw = pages.select("url", F.posexplode(web.links_in(F.col("html"))).alias("pos", "href"))
    absolute = raw.withColumn("link", web.joined_url(F.col("url"), F.col("href")))
    kept = absolute.where(F.col("link").isNotNull() & web.is_pdf_like(F.col("link")))
    return kept.groupBy("url", "link").agg(F.min("pos").alias("pos")).select("url", "pos", "link")


def resolved(results: DataFrame, pages: DataFrame, least: int = LEAST_SCORE) -> DataFrame:
    """Search results (query, rank, title, url) with pdf_url and how it was found: a PDF of OpenReview
    or arXiv, the URL itself, the PDF of an OpenReview forum whose page is about the query, or the best
    link of a page. A link scores by its own name or by the result's title with the page's first 1000
    characters, whichever is higher, the first among equals; a weak one counts only if the page is
    about the query."""
    rows = results.withColumn("url", web.unwrapped(F.col("url")))
    u = F.col("url")
    own_pdf = web.is_openreview(u) & web.path(u).startswith("/pdf")
    forum = web.openreview_pdf(u).isNotNull() & ~own_pdf
    direct = rows.withColumns({
        "pdf_url": F.when(own_pdf, u).when(web.is_arxiv(u), web.arxiv_pdf(u)).when(~forum & web.is_pdf(u), u),
        "found_by": F.when(own_pdf, "openreview").when(web.is_arxiv(u), "arxiv").when(~forum & web.is_pdf(u), "direct"),
        "__forum": forum,
    })
    need = direct.where("found_by is null").select("query", "rank", "title", "url", "__forum")
    # pages are joined to the results that still need them before any page is read. No side is bounded,
    # and Spark takes pages and exploded results for small: without the hints they go through the driver
    own = pages.join(need.select("url").distinct().hint("merge"), "url", "left_semi")
    read = need.join(own.hint("merge"), "url").withColumn("about", web.page_relevant(F.col("html"), F.col("query")))
    tokens = tx.query_tokens(F.col("query"))
    hits = lambda c: F.when(F.size(tokens) == 0, 0).otherwise(tx.token_hits(c, tokens))
    around = hits(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.left(F.coalesce("html", F.lit("")), F.lit(1000))))
    places = read.where(~F.col("__forum")).select("query", "rank", "url", "about", around.alias("around"))
    scored = places.join(page_links(own).hint("merge"), "url").withColumn("score", F.greatest(hits(F.col("link")), "around"))
    best = scored.withColumn("__n", F.row_number().over(Window.partitionBy("query", "rank").orderBy(F.desc("score"), "pos"))).where("__n = 1")
    best = best.where((F.col("score") >= least) | F.col("about")).select("query", "rank", F.col("link").alias("__link"), F.lit("page").alias("__by"))
    forums = read.where(F.col("__forum") & F.col("about")).select("query", "rank", web.openreview_pdf(F.col("url")).alias("__link"), F.lit("openreview").alias("__by"))
    found = best.unionByName(forums)
    return direct.drop("__forum").join(found.hint("merge"), ["query", "rank"], "left").withColumns({"pdf_url": F.coalesce("pdf_url", "__link"), "found_by": F.when(F.coalesce("pdf_url", "__link").isNotNull(), F.coalesce("found_by", "__by"))}).drop("__link", "__by")


def first_usable(found: DataFrame, downloads: DataFrame) -> DataFrame:
    """(query, pdf_url, rank, result_title) of the first relevant result whose PDF could be had;
    downloads: (pdf_url, ok)."""
    ok = downloads.where("ok").select("pdf_url").distinct()
    usable = found.where(F.col("pdf_url").isNotNull() & web.title_relevant(F.col("title"), F.col("query"))).join(ok.hint("merge"), "pdf_url", "left_semi")
    return usable.groupBy("query").agg(F.min_by(F.struct("pdf_url", F.col("title").alias("result_title")), "rank").alias("b"), F.min("rank").alias("rank")).select("query", "b.pdf_url", "rank", "b.result_title")


def cached_paths(papers: DataFrame, cache: DataFrame, folder: str) -> DataFrame:
    """papers with the file that the cache has for them, else the one that is to be expected."""
    expected = F.concat(F.lit(folder.rstrip("/") + "/"), tx.pdf_filename(F.col("paper_id"), F.col("paper_title")))
    return papers.join(cache.select("paper_id", F.col("path").alias("__p")), "paper_id", "left").withColumns({"pdf_path": F.coalesce(tx.blank_to_null(F.col("__p")), expected), "from_cache": F.col("__p").isNotNull()}).drop("__p")
