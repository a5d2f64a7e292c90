"""All queries of the engine's own operators, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..functions import web
from ..operators import caches, honors, pdf, references, reports, scoring, status, works
from ..session import cut, table
from . import analogues as an

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    from . import finding, matching, shaping  # noqa: F401  they register their queries

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)


def longs(df: DataFrame) -> DataFrame:
    """Integers as longs, so that both engines name the same type."""
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "bigint", "tinyint", "smallint") else F.col(c) for c, t in df.dtypes])


TARGET = "1-URGENT"


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return works.enriched(an.works(spark, sf), an.metrics(spark, sf))


def _recalls(spark: SparkSession, sf: str, base: DataFrame) -> DataFrame:
    found = cut(works.citing(base, an.citations(spark, sf), TARGET))
    return works.merged_recalls(("top_cited", works.most_cited(found, 200)), ("recent_year", works.in_years(found, 1998)))


RECALL_SQL = f"""
top AS (SELECT * FROM w WHERE cited_id = '{TARGET}' ORDER BY cited_by_count DESC, year DESC, paper_id LIMIT 200),
recent AS (SELECT * FROM w WHERE cited_id = '{TARGET}' AND year >= 1998),
r AS (SELECT w.*, w.paper_id IN (SELECT paper_id FROM top) AS t, w.paper_id IN (SELECT paper_id FROM recent) AS y FROM w
      WHERE w.paper_id IN (SELECT paper_id FROM top UNION SELECT paper_id FROM recent)),
rec AS (SELECT *, CASE WHEN t AND y THEN 'top_cited,recent_year' WHEN t THEN 'top_cited' ELSE 'recent_year' END AS sources FROM r)
"""

# -- recall, enrichment, selection ----------------------------------------------------------------


@query(f"""WITH {an.SQL}, {RECALL_SQL}
SELECT rec.paper_id, rec.paper_title, rec.year::BIGINT AS year, rec.cited_by_count::BIGINT AS cited_by_count, best.best_author, best.max_h::BIGINT AS max_h, rec.sources, 'fallback' AS selection_reason
FROM rec JOIN best USING (paper_id) WHERE best.max_h >= 60
ORDER BY best.max_h DESC, rec.cited_by_count DESC, rec.year DESC, rec.paper_title, rec.ord LIMIT 10""")
def flagship(spark, sf):
    """SRC03, SRC04, SET01, JOI01, AGG02, FLT03, SRT10: the most influential citing works."""
    base = cut(_recalls(spark, sf, an.works(spark, sf).withColumn("k", F.col("ord"))))
    rows, _ = works.split_by_h_index(cut(works.enriched(base, an.metrics(spark, sf))), 60)
    rows = rows.withColumns({"max_h_index_author": works.max_h_index_author(F.col("authors")), "has_fellow_topk": F.lit(False), "ord": F.col("k")})
    out = works.selected(rows, 10)
    return longs(out.select("paper_id", "paper_title", "year", "cited_by_count", F.col("max_h_index_author.author_id").alias("best_author"), F.col("max_h_index_author.h_index").alias("max_h"), F.array_join("recall_sources", ",").alias("sources"), "selection_reason"))


@query(f"WITH {an.SQL} SELECT paper_id, cited_by_count::BIGINT AS cited_by_count FROM w WHERE cited_id = '{TARGET}' ORDER BY cited_by_count DESC, year DESC, paper_id LIMIT 50")
def src03_top_cited(spark, sf):
    return longs(works.top_cited(an.works(spark, sf), an.citations(spark, sf), TARGET, 50).select("paper_id", "cited_by_count"))


@query(f"WITH {an.SQL} SELECT paper_id, year::BIGINT AS year FROM w WHERE cited_id = '{TARGET}' AND year BETWEEN 1995 AND 1996")
def src04_recent_citing(spark, sf):
    return longs(works.recent_citing(an.works(spark, sf), an.citations(spark, sf), TARGET, 1995, 1996).select("paper_id", "year"))


@query("SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def src05_bulk_by_ids(spark, sf):
    from ..sources import tables

    ids = table(spark, sf, "lineitem").where(F.col("l_quantity") >= 50).select("l_orderkey")
    return tables.by_ids(table(spark, sf, "orders"), ids, "o_orderkey").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def src02_point_lookup(spark, sf):
    from ..sources import tables

    return tables.by_id(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 42)


@query(f"WITH {an.SQL}, {RECALL_SQL} SELECT paper_id, sources FROM rec")
def set01_merged_recalls(spark, sf):
    return _recalls(spark, sf, an.works(spark, sf)).select("paper_id", F.array_join("recall_sources", ",").alias("sources"))


@query(f"WITH {an.SQL} SELECT paper_id, pos::BIGINT AS pos, author_id, h::BIGINT AS h_index, CASE WHEN known THEN 'Institute ' || (l_suppkey % 7) END AS affiliation FROM a")
def joi01_enrichment(spark, sf):
    return longs(works.bridge(_enriched(spark, sf)).select("paper_id", F.col("author_pos").alias("pos"), "author_id", "h_index", "affiliation"))


@query(f"WITH {an.SQL} SELECT paper_id, sum(coalesce(h, 0))::BIGINT AS h_sum, count(h) AS known FROM a GROUP BY paper_id")
def joi02_overwriting_enrichment(spark, sf):
    rows = works.enriched(works.with_h_index_defaults(an.works(spark, sf)), an.metrics(spark, sf), overwrite=True)
    known = F.filter("authors", lambda a: a["h_index"].isNotNull())
    return longs(rows.where(F.size("authors") > 0).select("paper_id", F.aggregate(known, F.lit(0).cast("long"), lambda s, a: s + a["h_index"]).alias("h_sum"), F.size(known).alias("known")))


@query(f"WITH {an.SQL} SELECT paper_id, best_author, max_h::BIGINT AS max_h FROM best")
def agg02_max_h_author(spark, sf):
    rows = _enriched(spark, sf).where(F.size("authors") > 0).select("paper_id", works.max_h_index_author(F.col("authors")).alias("m"))
    return longs(rows.select("paper_id", F.col("m.author_id").alias("best_author"), F.col("m.h_index").alias("max_h")))


@query(f"WITH {an.SQL} SELECT w.paper_id, max(a.h)::BIGINT AS max_h FROM w LEFT JOIN a USING (paper_id) GROUP BY w.paper_id")
def agg03_max_h(spark, sf):
    return longs(_enriched(spark, sf).select("paper_id", works.max_h_index(F.col("authors")).alias("max_h")))


@query(f"WITH {an.SQL}, f AS (SELECT author_id, min(row(ord, pos)) AS first_at FROM a GROUP BY author_id) SELECT author_id, row_number() OVER (ORDER BY first_at) AS place FROM f")
def agg04_author_ids(spark, sf):
    from pyspark.sql import Window

    rows = an.works(spark, sf)
    flat = rows.select("ord", F.posexplode("authors").alias("pos", "a")).groupBy("a.author_id").agg(F.min(F.struct("ord", "pos")).alias("at"))
    return longs(works.author_ids(rows).join(flat, "author_id").select("author_id", F.row_number().over(Window.orderBy("at")).alias("place")))


@query(f"WITH {an.SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY coalesce(h, 0) DESC, name, pos) AS n FROM a) SELECT paper_id, string_agg(author_id, ',' ORDER BY n) AS top FROM k WHERE n <= 2 GROUP BY paper_id")
def win02_top_authors(spark, sf):
    rows = _enriched(spark, sf).where(F.size("authors") > 0)
    return rows.select("paper_id", F.array_join(F.transform(works.top_authors(F.col("authors"), 2), lambda a: a["author_id"]), ",").alias("top"))


@query(f"WITH {an.SQL} SELECT w.paper_id, coalesce(bool_or(a.l_suppkey IN (3, 7)), false) AS dropped FROM w LEFT JOIN a USING (paper_id) GROUP BY w.paper_id")
def flt02_ignored_authors(spark, sf):
    kept, dropped = works.split_ignored(an.works(spark, sf), ["supplier no 3", "SUPPLIER, NO. 7"])
    return kept.select("paper_id", F.lit(False).alias("dropped")).unionByName(dropped.select("paper_id", F.lit(True).alias("dropped")))


@query(f"WITH {an.SQL} SELECT w.paper_id, coalesce(max_h, 0) < 80 AS dropped FROM w LEFT JOIN best USING (paper_id)")
def flt03_h_index_threshold(spark, sf):
    kept, dropped = works.split_by_h_index(_enriched(spark, sf), 80)
    return kept.select("paper_id", F.lit(False).alias("dropped")).unionByName(dropped.select("paper_id", F.lit(True).alias("dropped")))


@query(f"""WITH {an.SQL}, {RECALL_SQL}, k AS (SELECT rec.*, coalesce(max_h, 0) AS h, row_number() OVER (PARTITION BY y AND NOT t ORDER BY coalesce(max_h, 0) DESC, cited_by_count DESC, year DESC, paper_title, ord) AS n
FROM rec LEFT JOIN best USING (paper_id)) SELECT paper_id, sources FROM k WHERE NOT (y AND NOT t) OR n <= 30""")
def flt05_recent_only_cap(spark, sf):
    base = _recalls(spark, sf, an.works(spark, sf).withColumn("k", F.col("ord"))).withColumn("ord", F.col("k"))
    kept, _ = works.split_recent_only(cut(works.enriched(cut(base), an.metrics(spark, sf))), 30)
    return kept.select("paper_id", F.array_join("recall_sources", ",").alias("sources"))


@query(f"WITH {an.SQL} SELECT paper_id FROM a GROUP BY paper_id HAVING coalesce(max(h), 0) >= 95 OR CASE WHEN bool_or(l_linenumber = 1) THEN arg_min(coalesce(h, 0), pos) FILTER (l_linenumber = 1) ELSE arg_min(coalesce(h, 0), pos) END >= 70")
def flt06_h_index_either(spark, sf):
    return works.h_index_either(_enriched(spark, sf), 95, 70).select("paper_id")


@query(f"WITH {an.SQL} SELECT paper_id, cited_by_count::BIGINT AS cited_by_count FROM w WHERE paper_id IN (SELECT paper_id FROM a WHERE author_id = '5' AND l_linenumber = 1) ORDER BY cited_by_count DESC, year DESC, paper_id LIMIT 20")
def flt07_first_author_works(spark, sf):
    return longs(works.author_works(an.works(spark, sf), "5", 20, only_first=True).select("paper_id", "cited_by_count"))


@query(f"WITH {an.SQL} SELECT w.paper_id, coalesce(bool_or(a.author_id = '4'), false) AS self_citation FROM w LEFT JOIN a USING (paper_id) GROUP BY w.paper_id")
def joi05_self_citation(spark, sf):
    return an.works(spark, sf).select("paper_id", works.self_citation(F.col("authors"), F.lit("supplier, no 4")).alias("self_citation"))


@query(f"WITH {an.SQL} SELECT w.paper_id, coalesce(max_h, 0)::BIGINT AS max_h FROM w LEFT JOIN best USING (paper_id) WHERE ord % 10 = 3")
def srt10_primary_selection(spark, sf):
    """A work with a fellow silences the fallback: all that have one stay."""
    rows = _enriched(spark, sf).withColumns({"max_h_index_author": works.max_h_index_author(F.col("authors")), "has_fellow_topk": F.col("ord") % 10 == 3})
    return longs(works.selected(cut(rows), 5).select("paper_id", F.coalesce("max_h_index_author.h_index", F.lit(0)).alias("max_h")))


@query("""SELECT count_if(o_orderstatus = 'F')::BIGINT AS published, count_if(o_orderstatus = 'O')::BIGINT AS informal, count_if(o_orderstatus NOT IN ('F', 'O'))::BIGINT AS unknown, count_if(o_totalprice < 1000)::BIGINT AS errors FROM orders""")
def agg01_status_counts(spark, sf):
    s = F.when(F.col("o_orderstatus") == "F", "Published").when(F.col("o_orderstatus") == "O", "informal").otherwise("odd")
    rows = table(spark, sf, "orders").select(F.struct(s.alias("status")).alias("publication_status"), F.when(F.col("o_totalprice") < 1000, "x").alias("status_error"))
    return status.status_counts(rows)


# -- scores and reports ---------------------------------------------------------------------------


@query(f"WITH {an.CONTEXTS_SQL} SELECT paper_id, ctx_pos, s::BIGINT AS remark_score FROM c")
def txt27_mock_score(spark, sf):
    return longs(an.contexts(spark, sf).select("paper_id", "ctx_pos", "remark_score"))


@query(f"""WITH {an.CONTEXTS_SQL} SELECT d.doc_id AS paper_id, count(c.paper_id) AS contexts_total, count(s) AS scored, count(err) AS errors, round(avg(s), 6) AS mean_score, median(s)::DOUBLE AS median_score,
count(*) FILTER (s <= 3) AS neg, count(*) FILTER (s > 3 AND s <= 6) AS neutral, count(*) FILTER (s > 6) AS pos FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN c ON d.doc_id = c.paper_id GROUP BY d.doc_id""")
def agg06_paper_summaries(spark, sf):
    papers = table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id")).distinct()
    return longs(reports.paper_summaries(papers, an.contexts(spark, sf)).withColumn("mean_score", F.round("mean_score", 6)))


@query(f"""WITH {an.CONTEXTS_SQL}, p AS (SELECT paper_id, count(*) AS n, count(s) AS k, avg(s) AS m, count(err) AS e FROM c GROUP BY paper_id)
SELECT count(*) AS papers, sum(n)::BIGINT AS contexts_total, sum(k)::BIGINT AS scored, sum(e)::BIGINT AS errors, round(sum(m * k) / sum(k), 6) AS mean_score FROM p""")
def agg07_weighted_overall(spark, sf):
    c = an.contexts(spark, sf)
    out = reports.overall_weighted(reports.paper_summaries(c.select("paper_id").distinct(), c))
    return longs(out.select("papers", "contexts_total", "scored", "errors", F.round("mean_score", 6).alias("mean_score")))


@query(f"WITH {an.CONTEXTS_SQL} SELECT count(DISTINCT paper_id) AS papers, count(*) AS contexts_total, count(s) AS scored, count(err) AS errors, round(avg(s), 6) AS mean_score, median(s)::DOUBLE AS median_score FROM c")
def agg08_exact_overall(spark, sf):
    c = an.contexts(spark, sf)
    out = reports.overall_exact(c.select("paper_id").distinct(), c)
    return longs(out.select("papers", "contexts_total", "scored", "errors", F.round("mean_score", 6).alias("mean_score"), "median_score"))


@query(f"""WITH {an.CONTEXTS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY s DESC, ctx_pos) AS b, row_number() OVER (PARTITION BY paper_id ORDER BY s, ctx_pos DESC) AS l FROM c WHERE s IS NOT NULL)
SELECT paper_id, 'positive' AS side, b AS rank, ctx_pos, s::BIGINT AS remark_score FROM k WHERE b <= 2 UNION ALL SELECT paper_id, 'negative', l, ctx_pos, s::BIGINT FROM k WHERE l <= 2""")
def srt06_top_contexts(spark, sf):
    return longs(reports.top_contexts(an.contexts(spark, sf), 2).select("paper_id", "side", "rank", "ctx_pos", "remark_score"))


@query("""SELECT event_id, json_extract_string(props, '$.page') AS page, CASE WHEN value IS NOT NULL THEN greatest(0, least(10, round_even(value, 0)))::BIGINT END AS score FROM events""")
def txt26_score_coercion(spark, sf):
    """Reply parsing: JSON fields and a score rounded half to even."""
    e = table(spark, sf, "events")
    return longs(e.select("event_id", F.try_variant_get(tx.lenient_json(F.col("props")), "$.page", "string").alias("page"), tx.coerced_score(F.col("value").cast("string")).alias("score")))


@query("""SELECT conv_id AS paper_id, turn AS ctx_pos, CASE WHEN turn < 3 AND turn % 2 = 1 THEN ('0x' || substr(md5('t|' || text), 1, 2))::INT % 11 WHEN turn % 2 = 0 THEN 5 END::BIGINT AS remark_score FROM conversations""")
def flt15_scoring_budget(spark, sf):
    """Scored contexts use up the budget too."""
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("ctx_pos"), F.lit("t").alias("target_title"), F.col("text").alias("context"), F.when(F.col("turn") % 2 == 0, 5).alias("remark_score"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("remark_error"))
    return longs(scoring.dry_run(rows, 3).select("paper_id", "ctx_pos", "remark_score"))


# -- texts ------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[\s\x0b]+', ' ', 'g'), '[^\p{L}\p{N}\p{M}_\s]', '', 'g'))) AS a,
md5(trim(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g'))) AS c, md5(trim(regexp_replace(replace(replace(lower(text), ',', ' '), '.', ' '), '[\s\x0b]+', ' ', 'g'))) AS author,
md5(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS surname FROM documents""")
def txt01_norms(spark, sf):
    """TXT01, TXT03, TXT04, TXT06."""
    t = F.col("text")
    md5 = lambda c: F.md5(c.cast("binary"))
    return table(spark, sf, "documents").select("doc_id", md5(tx.title_norm(t)).alias("a"), md5(tx.alnum_norm(t)).alias("c"), md5(tx.author_norm(t)).alias("author"), md5(tx.surname_norm(t)).alias("surname"))


@query(r"""WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) > 260 THEN left(t, 257) || '...' ELSE t END AS snippet FROM s""")
def txt08_snippet(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.snippet(F.col("text")).alias("snippet"))


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(p_name || ' (v/' || p_size || ')', '[^A-Za-z0-9-]+', '_', 'g'), '_+', '_', 'g'), '_') AS tag,
trim(regexp_replace(p_brand, '[^\w.-]+', '_', 'g'), '_') || '_' || trim(regexp_replace(p_name, '[^\w.-]+', '_', 'g'), '_') || '.pdf' AS file FROM part""")
def txt11_names(spark, sf):
    """TXT11, TXT12: file names and run tags."""
    return table(spark, sf, "part").select("p_partkey", tx.run_tag(F.concat("p_name", F.lit(" (v/"), F.col("p_size").cast("string"), F.lit(")"))).alias("tag"), tx.pdf_filename(F.col("p_brand"), F.col("p_name")).alias("file"))


@query(r"""WITH t AS (SELECT p_partkey, p_type, list_filter(string_split_regex(lower(p_name || ' paper for ' || p_brand), '\W+'), lambda x: length(x) > 2 AND x NOT IN ('pdf', 'paper', 'arxiv', 'openreview', 'ieee', 'proceedings', 'www', 'http', 'https')) AS w, lower(p_name) AS n FROM part),
h AS (SELECT *, len(list_filter(w, lambda x: contains(n, x))) AS hits FROM t)
SELECT p_partkey, array_to_string(w, ' ') AS tokens, hits::BIGINT AS hits, hits >= 1 AND hits / len(w) >= 0.4 AS relevant FROM h""")
def txt15_title_tokens(spark, sf):
    """TXT14, TXT15, FLT09."""
    q = F.concat("p_name", F.lit(" paper for "), "p_brand")
    tokens = tx.query_tokens(q)
    return longs(table(spark, sf, "part").select("p_partkey", F.array_join(tokens, " ").alias("tokens"), tx.token_hits(F.col("p_name"), tokens).alias("hits"), web.title_relevant(F.col("p_name"), q, 1, 0.4).alias("relevant")))


@query(r"""SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, len(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda x: x != ''))::BIGINT AS depth,
len(regexp_extract_all(html, '(?i)(?:href|src)=["'']([^"'']+)["'']'))::BIGINT AS links, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS plain FROM pages""")
def txt21_urls(spark, sf):
    """TXT21, EXT08, FLT10: hosts, depths, links and page text without tags."""
    p = table(spark, sf, "pages")
    return longs(p.select("page_id", web.host(F.col("url")).alias("host"), web.path_depth(F.col("url")).alias("depth"), F.size(web.links_in(F.col("html"))).alias("links"), F.md5(F.regexp_replace("html", "<[^>]+>", " ").cast("binary")).alias("plain")))


@query(r"""WITH u AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'https://arxiv.org/abs/' || p_partkey WHEN 1 THEN 'https://arxiv.org/pdf/' || p_partkey WHEN 2 THEN 'https://openreview.net/forum?id=x' || p_partkey WHEN 3 THEN 'http://a.edu/~p' || p_partkey || '/paper.pdf?x=1' ELSE 'ftp://b.org/' || p_partkey END AS url FROM part)
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'https://arxiv.org/pdf/' || p_partkey || '.pdf' WHEN 1 THEN 'https://arxiv.org/pdf/' || p_partkey || '.pdf' END AS arxiv,
CASE WHEN p_partkey % 5 = 2 THEN 'https://openreview.net/pdf?id=x' || p_partkey END AS openreview, p_partkey % 5 = 3 AS pdf_like, CASE WHEN p_partkey % 5 = 4 THEN 'invalid_scheme' ELSE 'blocked_domain_or_pdf' END AS admission FROM u""")
def txt22_pdf_urls(spark, sf):
    """TXT22, FLT11, FLT12, FLT13."""
    k = F.col("p_partkey").cast("string")
    r = F.col("p_partkey") % 5
    url = F.when(r == 0, F.concat(F.lit("https://arxiv.org/abs/"), k)).when(r == 1, F.concat(F.lit("https://arxiv.org/pdf/"), k)).when(r == 2, F.concat(F.lit("https://openreview.net/forum?id=x"), k)).when(r == 3, F.concat(F.lit("http://a.edu/~p"), k, F.lit("/paper.pdf?x=1"))).otherwise(F.concat(F.lit("ftp://b.org/"), k))
    rows = table(spark, sf, "part").select("p_partkey", url.alias("u"))
    return rows.select("p_partkey", web.arxiv_pdf(F.col("u")).alias("arxiv"), web.openreview_pdf(F.col("u")).alias("openreview"), web.is_pdf_like(F.col("u")).alias("pdf_like"), web.admission(F.col("u"), False).alias("admission"))


# -- references and contexts ------------------------------------------------------------------------


@query(f"""WITH {an.CITED_SQL}, g AS (SELECT doc_id, body, string_split_regex(body, '\\[\\s*(\\d(?:[\\d\\s,;–−-]*\\d)?)\\s*\\]') AS g, regexp_extract_all(body, '\\[\\s*(?:\\d(?:[\\d\\s,;–−-]*\\d)?)\\s*\\]') AS h FROM p),
e AS (SELECT doc_id, body, g, h, unnest(range(len(h))) AS i FROM g),
x AS (SELECT doc_id, body, h[i + 1] AS hit, len(array_to_string(g[1:i + 1], '')) + len(array_to_string(h[1:i], '')) AS a, regexp_replace(h[i + 1], '[\\[\\]\\s]', '', 'g') AS inner_ FROM e)
SELECT doc_id, hit AS match_text, a::BIGINT AS start, (a + len(hit))::BIGINT AS end_, substr(body, (greatest(0, a - 40) + 1)::BIGINT, (least(len(body), a + len(hit) + 40) - greatest(0, a - 40))::BIGINT) AS context
FROM x WHERE len(list_filter(string_split_regex(inner_, '[;,]'), lambda q: CASE WHEN regexp_matches(q, '^\\d+[–−-]\\d+$') THEN 14 BETWEEN least(try_cast(regexp_extract(q, '^(\\d+)', 1) AS INT), try_cast(regexp_extract(q, '(\\d+)$', 1) AS INT)) AND greatest(try_cast(regexp_extract(q, '^(\\d+)', 1) AS INT), try_cast(regexp_extract(q, '(\\d+)$', 1) AS INT)) ELSE coalesce(try_cast(q AS INT) = 14, false) END)) > 0""")
def ext04_numeric_contexts(spark, sf):
    rows = an.cited_texts(spark, sf).select("doc_id", F.explode(references.numeric_contexts(F.col("body"), F.lit(14), 40)).alias("c"))
    return longs(rows.select("doc_id", "c.match_text", "c.start", F.col("c.end").alias("end_"), "c.context"))


@query(f"""WITH {an.CITED_SQL} SELECT doc_id, md5(body) AS body, r.id::BIGINT AS ref_id, r.raw AS raw_text, r.k AS author_year_key FROM p, LATERAL (SELECT unnest([
{{'id': 1, 'raw': '[1] Aa B. Old title ' || (doc_id % 13) || '. 1999.', 'k': 'aa|1999'}}, {{'id': 2, 'raw': '[2] Cc D. New title ' || (doc_id % 17) || '. 2004b.', 'k': 'cc|2004b'}}, {{'id': 3, 'raw': '[3] Ee F. Last one. 2011.', 'k': 'ee|2011'}}]) AS r)""")
def ext01_bibliography(spark, sf):
    """EXT01, EXT02, EXT03: the last heading splits, markers part entries."""
    rows = an.cited_texts(spark, sf).select(F.col("doc_id").alias("paper_id"), references.split_text(F.col("text")).alias("s")).select("paper_id", "s.body", "s.references")
    parsed = references.with_entries(rows)
    flat = references.entry_table(parsed).join(rows.select("paper_id", F.md5(F.col("body").cast("binary")).alias("body")), "paper_id")
    return longs(flat.select(F.col("paper_id").alias("doc_id"), "body", "ref_id", "raw_text", "author_year_key"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR doc_id % 4 = 2 THEN 'Yes' ELSE 'Unknown' END AS ieee, CASE WHEN doc_id % 4 = 0 OR doc_id % 4 = 1 THEN 'Yes' ELSE 'Unknown' END AS acm, 'Unknown' AS aaai FROM documents WHERE text IS NOT NULL""")
def ext16_honor_rules(spark, sf):
    r = F.col("doc_id") % 4
    said = F.when(r == 0, " an ACM / IEEE Fellow.").when(r == 1, " not an ACM\nFellow.").when(r == 2, " IEEE  Fellow ").otherwise(" no honors")
    s = honors.rule_statuses(F.concat("text", said))
    return table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", s.alias("s")).select("doc_id", "s.ieee", "s.acm", "s.aaai")


@query("""WITH e AS (SELECT user_id, event_id, event_type, CASE WHEN value > 80 THEN 'Yes' WHEN value > 40 THEN 'No' ELSE 'Unknown' END AS st FROM events)
SELECT user_id, event_type, arg_min(st, row(CASE st WHEN 'Yes' THEN 0 WHEN 'No' THEN 1 ELSE 2 END, event_id)) AS status,
CASE WHEN bool_or(st != 'Unknown') THEN arg_min(event_id, row(CASE st WHEN 'Yes' THEN 0 WHEN 'No' THEN 1 ELSE 2 END, event_id)) END::VARCHAR AS source FROM e GROUP BY user_id, event_type""")
def agg11_evidence(spark, sf):
    """AGG11, AGG12: Yes over No over Unknown, first source."""
    s = F.when(F.col("value") > 80, "Yes").when(F.col("value") > 40, "No").otherwise("Unknown")
    rows = table(spark, sf, "events").select(F.col("user_id").alias("author_key"), F.col("event_id").alias("ord"), F.col("event_type").alias("org"), s.alias("status"), F.col("event_id").cast("string").alias("source"))
    return honors.merged_evidence(rows).select(F.col("author_key").alias("user_id"), F.col("org").alias("event_type"), "status", "source")


@query("""WITH v AS (SELECT * FROM events WHERE epoch(ts) IS NOT NULL AND 1706745600 - epoch(ts) <= 20 * 86400 AND user_id % 3 != 0)
SELECT user_id, arg_max(event_id, row(ts, event_id)) AS event_id FROM v GROUP BY user_id""")
def flt17_cache(spark, sf):
    """FLT17, SNK10: valid entries, the latest of each key."""
    e = table(spark, sf, "events").select("user_id", "event_id", F.unix_timestamp("ts").cast("string").alias("timestamp"), F.when(F.col("user_id") % 3 == 0, 1).otherwise(2).alias("version"), F.struct("ts", "event_id").alias("at"))
    return caches.latest(caches.valid(e, 1706745600.0, 20), "user_id", "at").select("user_id", "event_id")


@query("SELECT c_custkey, (length(c_name) + 40)::BIGINT AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def flt16_without_output(spark, sf):
    """FLT16, JOI11: what has no output or cache entry yet."""
    from ..sources import tables

    c = table(spark, sf, "customer").withColumn("paper_id", F.col("c_custkey"))
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("paper_id"))
    return longs(tables.without_output(c, done).select("c_custkey", (F.length("c_name") + 40).alias("n")))


@query()
def ext11_page_text(spark, sf):
    """EXT11, EXT12: body text and its quality."""
    p = table(spark, sf, "pages").withColumn("t", web.body_text(F.col("html")))
    return p.select("page_id", F.length("t").alias("chars"), F.md5(F.col("t").cast("binary")).alias("digest"), web.page_quality(F.col("t"), F.lit("Ann Lee"), F.lit("MIT"), F.lit("")).alias("quality"))


@query()
def txt02_bibliography_norm(spark, sf):
    """TXT02: NFKC only where texts are not ASCII."""
    d = sim.with_bibliography_norm(table(spark, sf, "documents").select("doc_id", "text"), "text", "norm")
    return d.select("doc_id", F.md5(F.col("norm").cast("binary")).alias("norm"))
