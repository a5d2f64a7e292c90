"""Queries of title matching, publication status, bibliographies, contexts and sheets.

Similarity ratios can be told in SQL where one string begins with the other, so the candidates here
are made that way: 2 * the shorter length / both lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web
from ..operators import references, reports, status, works
from ..session import cut, table
from ..sources import tables
from . import analogues as an
from . import pipelines
from .params import Params
from .registry import longs, query

TITLE_NORM = r"trim(regexp_replace(regexp_replace(lower({0}), '[\s\x0b]+', ' ', 'g'), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', '', 'g'))"
PLAIN_NORM = r"trim(regexp_replace(regexp_replace(trim(lower({0})), '[.\s]+$', ''), '[^0-9a-z]+', ' ', 'g'))"


def _text(*parts: str | Column) -> Column:
    """Strings and columns as one text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# -- titles and publication status ------------------------------------------------------------------


@query(rf"""
WITH t AS (
  SELECT doc_id AS paper_id, list_distinct(list_filter(string_split({TITLE_NORM.format("string_split(text, chr(10))[1]")}, ' '), lambda w: w != '')) AS words
  FROM documents WHERE text IS NOT NULL
), q AS (
  SELECT item_id AS query_id, list_distinct(list_filter(string_split({TITLE_NORM.format("left(text, 60)")}, ' '), lambda w: w != '')) AS words FROM benchmark
), tw AS (SELECT paper_id, unnest(words) AS w FROM t),
common AS (SELECT w FROM tw GROUP BY w HAVING count(*) > (SELECT count(*) FROM t) / 10),
qw AS (SELECT query_id, unnest(words) AS w FROM q),
marked AS (SELECT query_id, w, w IN (SELECT w FROM common) AS c FROM qw),
gen AS (SELECT query_id, w FROM (SELECT *, bool_and(c) OVER (PARTITION BY query_id) AS all_c FROM marked) WHERE NOT c OR all_c),
pairs AS (SELECT DISTINCT query_id, paper_id FROM gen JOIN tw USING (w)),
shared AS (SELECT query_id, paper_id, count(*) AS shared FROM pairs JOIN qw USING (query_id) JOIN tw USING (paper_id, w) GROUP BY query_id, paper_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, paper_id) - 1 AS pos FROM shared)
SELECT query_id, paper_id, shared, pos FROM placed WHERE pos < 5""")
def joi06_title_search(spark: SparkSession, sf: str) -> DataFrame:
    """JOI06: the heads of benchmark items against the first lines of all documents."""
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.left("text", F.lit(60)).alias("query_title"))
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    t = d.select(F.col("doc_id").alias("paper_id"), F.split("text", "\n")[0].alias("paper_title"))
    return longs(status.candidates_by_token(q, t, 5).select("query_id", "paper_id", "shared", "pos"))


@query(rf"""
WITH q AS (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_partkey AS t FROM part),
c AS (
  SELECT p_partkey, t, 0 AS pos, CASE WHEN p_partkey % 4 = 0 THEN '???' ELSE t || ' part ' || (p_partkey % 7) END AS title FROM q
  UNION ALL SELECT p_partkey, t, 1, CASE WHEN p_partkey % 3 = 0 THEN upper(t) || '!' ELSE t || ' and whatever else is long enough to be unlike it' END FROM q
  UNION ALL SELECT p_partkey, t, 2, 'ÿÿÿ' FROM q
  UNION ALL SELECT p_partkey, t, 3, t || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' 2' END FROM q
), n AS (SELECT p_partkey, pos, {TITLE_NORM.format("t")} AS a, {TITLE_NORM.format("title")} AS b FROM c),
s AS (SELECT p_partkey, pos, CASE WHEN pos = 2 OR b = '' THEN 0 ELSE 2.0 * length(a) / (length(a) + length(b)) END::DOUBLE AS score FROM n),
best AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, pos) AS r FROM s WHERE score > 0)
SELECT p_partkey, pos, round(score, 9) AS score, score >= 0.95 AS is_confident FROM best WHERE r = 1""")
def match01_titles(spark: SparkSession, sf: str) -> DataFrame:
    """MATCH01, WIN03: the best of several candidates of each part, ties by place."""
    k = F.col("p_partkey")
    q = table(spark, sf, "part").select("p_partkey", k.alias("query_id"), _text(F.col("p_name"), " ", F.col("p_brand"), " ", k).alias("query_title"))
    t = F.col("query_title")
    candidates = [
        F.when(k % 4 == 0, "???").otherwise(_text(t, " part ", k % 7)),
        F.when(k % 3 == 0, _text(F.upper(t), "!")).otherwise(_text(t, " and whatever else is long enough to be unlike it")),
        F.lit("ÿÿÿ"),
        F.when(k % 5 == 0, t).otherwise(_text(t, " 2")),
    ]
    pairs = q.select("*", F.posexplode(F.array(*candidates)).alias("pos", "candidate_title"))
    best = status.best_title_match(pairs, 0.95)
    return longs(best.select("p_partkey", "pos", F.round("score", 9).alias("score"), "is_confident"))


@query(rf"""
WITH q AS (SELECT p_partkey, p_name || ' ' || p_brand || ' no ' || p_partkey AS t FROM part),
h AS (
  SELECT p_partkey, t, 0 AS pos, t || '.' AS title, 'Venue' AS venue, CASE WHEN p_partkey % 3 = 0 THEN 'Informal and Other Publications' ELSE 'Journal Articles' END AS type, '2020' AS year FROM q
  UNION ALL SELECT p_partkey, t, 1, upper(t), 'CoRR', 'Journal Articles', '2021' FROM q WHERE p_partkey % 2 = 0
  UNION ALL SELECT p_partkey, t, 2, t || ' ii', 'Venue', 'Conference and Workshop Papers', '2019' FROM q WHERE p_partkey % 6 = 3
  UNION ALL SELECT p_partkey, t, 3, t || ' ü', 'Venue', 'Books', '2022' FROM q WHERE p_partkey % 5 = 0
), n AS (SELECT *, {PLAIN_NORM.format("t")} AS a, {PLAIN_NORM.format("replace(title, 'ü', 'u')")} AS b0, {PLAIN_NORM.format("title")} AS b FROM h WHERE p_partkey % 11 != 0),
s AS (SELECT *, 2.0 * length(a) / (length(a) + length(b)) AS sim, CASE WHEN type IN ('Journal Articles', 'Conference and Workshop Papers') AND venue != 'CoRR' THEN 0 WHEN type LIKE 'Informal%' OR venue = 'CoRR' THEN 1 ELSE 2 END AS kind FROM n),
best AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY kind, sim DESC, (p_partkey + pos) % 7 DESC, year DESC, pos) AS r FROM s WHERE sim >= 0.92)
SELECT q.p_partkey, CASE kind WHEN 0 THEN 'published' WHEN 1 THEN 'informal' ELSE 'unknown' END AS status, '10.1/' || pos AS doi, round(sim, 9)::DOUBLE AS similarity, CASE WHEN pos IS NULL THEN 'no_match' END AS status_error
FROM q LEFT JOIN best ON best.p_partkey = q.p_partkey AND r = 1""")
def cls01_publication_status(spark: SparkSession, sf: str) -> DataFrame:
    """CLS01, MATCH02, JOI07: the status of every part by hits made from its title."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select("p_partkey", _text(F.col("p_name"), " ", F.col("p_brand"), " no ", k).alias("query_title"))
    t = F.col("query_title")
    hit = lambda pos, title, venue, kind, year: F.struct(F.lit(pos).alias("pos"), title.alias("title"), F.lit(venue).alias("venue"), kind.alias("type"), F.lit(year).alias("year"))
    found = F.array(
        hit(0, _text(t, "."), "Venue", F.when(k % 3 == 0, status.INFORMAL).otherwise("Journal Articles"), "2020"),
        F.when(k % 2 == 0, hit(1, F.upper(t), "CoRR", F.lit("Journal Articles"), "2021")),
        F.when(k % 6 == 3, hit(2, _text(t, " ii"), "Venue", F.lit("Conference and Workshop Papers"), "2019")),
        F.when(k % 5 == 0, hit(3, _text(t, " ü"), "Venue", F.lit("Books"), "2022")),
    )
    hits = p.where(k % 11 != 0).select("p_partkey", "query_title", F.explode(F.filter(found, lambda h: h.isNotNull())).alias("h"))
    link = F.array(_text("https://doi.org/10.1/", F.col("pos")))
    hits = hits.select("query_title", "p_partkey", "h.*").select("query_title", "pos", ((k + F.col("pos")) % 7).cast("int").alias("hit_score"), "title", "venue", "year", "type", F.lit("u").alias("url"), F.lit(None).cast("string").alias("doi"), link.alias("links"))
    out = status.publication_status(p, hits)
    s = F.col("publication_status")
    return out.select("p_partkey", F.when(F.col("status_error").isNull(), s["status"]).otherwise("unknown").alias("status"), s["doi"].alias("doi"), F.round(s["similarity"], 9).alias("similarity"), "status_error")


# -- bibliographies and contexts --------------------------------------------------------------------

#: A bibliography in each of the shapes that have a way of splitting of their own.
SHAPES = {
    "numeric": "[1] Aa B. Old title {0}. 1999.\n[2] Cc D. New title {0}. 2004b.\n- [7] Ee F. Last one. 2011.\n",
    "numeric_list": "1. Aa B. Old title {0}, 1999.\n2) Cc D. New title {0}, 2004b.\n3. Ee F. One, 2001. 4. Gg H. Two, 2002.\n",
    "blank_lines": "Aa B. Old title {0} of some length. 1999.\n\nCc D. New title {0} of some length. 2004b.\n",
    "year_anchors": "Aa B. Old title {0}. 1999.\nsecond line of it\nCc D. New title {0}. 2004b.\n",
    "list_items": "- aa b, old title {0}\n* cc d, new title {0}\n",
    "single_entry": "aa b, old title {0} and nothing else",
    "empty": " \n",
}
#: What splitting makes of them.
PARTS = {
    "numeric": ["[1] Aa B. Old title {0}. 1999.", "[2] Cc D. New title {0}. 2004b.", "- [7] Ee F. Last one. 2011."],
    "numeric_list": ["1. Aa B. Old title {0}, 1999.", "2) Cc D. New title {0}, 2004b.", "3. Ee F. One, 2001.", "4. Gg H. Two, 2002."],
    "blank_lines": ["Aa B. Old title {0} of some length. 1999.", "Cc D. New title {0} of some length. 2004b."],
    "year_anchors": ["Aa B. Old title {0}. 1999.\nsecond line of it", "Cc D. New title {0}. 2004b."],
    "list_items": ["- aa b, old title {0}", "* cc d, new title {0}"],
    "single_entry": ["aa b, old title {0} and nothing else"],
    "empty": [],
}
IDS = {"numeric": [1, 2, 7], "numeric_list": [1, 2, 3, 4]}


def _sql_text(template: str) -> str:
    return " || n || ".join("'" + p.replace("\n", "' || chr(10) || '") + "'" for p in template.split("{0}"))


def _filled(template: str, n: Column) -> Column:
    parts = template.split("{0}")
    return _text(*[x for i, p in enumerate(parts) for x in ((n, p) if i else (p,))])


def _branches_sql() -> str:
    rows = []
    for i, shape in enumerate(SHAPES):
        entries = ", ".join(f"{{'id': {IDS.get(shape, [1, 2, 3])[j]}, 'raw': {_sql_text(p)}}}" for j, p in enumerate(PARTS[shape]))
        if entries:
            rows.append(f"SELECT doc_id, '{shape}' AS parse_method, e.id::BIGINT AS ref_id, e.raw AS raw_text FROM d, LATERAL (SELECT unnest([{entries}]) AS e) WHERE k = {i}")
        else:
            rows.append(f"SELECT doc_id, '{shape}', NULL, NULL FROM d WHERE k = {i}")
    return f"WITH d AS (SELECT doc_id, (doc_id % {len(SHAPES)}) AS k, (doc_id % 17)::VARCHAR AS n FROM documents WHERE text IS NOT NULL)\n" + "\nUNION ALL ".join(rows)


@query(_branches_sql())
def ext02_bibliography_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """EXT01, EXT02: every way of splitting a bibliography, after the text of a document."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    n, k = F.col("doc_id") % 17, F.col("doc_id") % len(SHAPES)
    refs = F.coalesce(*[F.when(k == i, _filled(shape, n)) for i, shape in enumerate(SHAPES.values())])
    text = _text(F.col("text"), "\n**References**\n", refs)
    parts = d.select(F.col("doc_id").alias("paper_id"), references.split_text(text).alias("s")).select("paper_id", "s.body", "s.references")
    rows = references.with_entries(parts).select("paper_id", "parse_method", F.explode_outer("entries").alias("e"))
    return longs(rows.select(F.col("paper_id").alias("doc_id"), "parse_method", "e.ref_id", "e.raw_text"))


@query(f"""
WITH {an.CITED_SQL}, g AS (SELECT doc_id, unnest(regexp_extract_all(body, '\\[\\s*(?:\\d(?:[\\d\\s,;–−-]*\\d)?)\\s*\\]')) AS hit FROM p),
x AS (SELECT doc_id, regexp_replace(hit, '[\\[\\]\\s]', '', 'g') AS inner_ FROM g),
n AS (SELECT doc_id, count(*) AS n FROM x WHERE len(list_filter(string_split_regex(inner_, '[;,]'), lambda q:
  CASE WHEN regexp_matches(q, '^\\d+[–−-]\\d+$') THEN 2 BETWEEN least(try_cast(regexp_extract(q, '^(\\d+)', 1) AS INT), try_cast(regexp_extract(q, '(\\d+)$', 1) AS INT)) AND greatest(try_cast(regexp_extract(q, '^(\\d+)', 1) AS INT), try_cast(regexp_extract(q, '(\\d+)$', 1) AS INT)) ELSE coalesce(try_cast(q AS INT) = 2, false) END)) > 0 GROUP BY doc_id)
SELECT doc_id AS paper_id, 2::BIGINT AS ref_id, 1.0::DOUBLE AS match_score, '[2] Cc D. New title ' || (doc_id % 17) || '. 2004b.' AS reference_entry, coalesce(n, 0) AS contexts,
  'mixed' AS citation_style, 'Cc|2004b' AS author_year_key, 'numeric' AS parse_method, 3::BIGINT AS num_entries FROM p LEFT JOIN n USING (doc_id)""")
def ext06_reference_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """EXT04, EXT06, JOI08, MATCH03 from end to end: the entry that has the title, and where it is cited."""
    d = an.cited_texts(spark, sf).select(F.col("doc_id").alias("paper_id"), "text", _text("New title ", F.col("doc_id") % 17).alias("title"))
    out = references.reference_contexts(d, 40, cut=cut)
    return longs(out.select("paper_id", "ref_id", "match_score", "reference_entry", F.size("contexts").alias("contexts"), "citation_style", "author_year_key", "parse_method", "num_entries"))


@query("""
WITH d AS (SELECT doc_id, 'Start. ' || CASE doc_id % 4 WHEN 0 THEN 'As shown (Aa, 1999; see Cc et al., 2004b) here.' WHEN 1 THEN 'Cc and Dd (2004a, b) say so.' WHEN 2 THEN 'Others (Cc 2004a; Dd 2004b) do not.' ELSE 'First (Cc, 2004b), then Cc et al. (2004b).' END || ' End.' AS body FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, body, unnest(CASE doc_id % 4 WHEN 0 THEN ['(Aa, 1999; see Cc et al., 2004b)'] WHEN 1 THEN ['Cc and Dd (2004a, b)'] WHEN 3 THEN ['(Cc, 2004b)', 'Cc et al. (2004b)'] ELSE [] END) AS match_text FROM d)
SELECT doc_id, match_text, (strpos(body, match_text) - 1)::BIGINT AS start, substr(body, greatest(0, strpos(body, match_text) - 1 - 12) + 1, least(length(body), strpos(body, match_text) - 1 + length(match_text) + 12) - greatest(0, strpos(body, match_text) - 1 - 12)) AS context FROM m""")
def ext05_author_year_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """EXT05, JOI10: citations in parentheses and in the sentence, years with several letters."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    r = F.col("doc_id") % 4
    said = F.when(r == 0, "As shown (Aa, 1999; see Cc et al., 2004b) here.").when(r == 1, "Cc and Dd (2004a, b) say so.").when(r == 2, "Others (Cc 2004a; Dd 2004b) do not.").otherwise("First (Cc, 2004b), then Cc et al. (2004b).")
    rows = d.select("doc_id", _text("Start. ", said, " End.").alias("body"))
    rows = rows.select("doc_id", F.explode(references.author_year_contexts(F.col("body"), F.lit(2), F.lit("Cc"), F.lit("2004b"), 12)).alias("c"))
    return longs(rows.select("doc_id", "c.match_text", "c.start", "c.context"))


@query("""
WITH d AS (SELECT doc_id, text, lower(text) AS low FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, text, unnest(['haan', 'ción', 'licensed']) AS k, low FROM d),
r AS (SELECT doc_id, text, strpos(low, k) - 1 AS p0 FROM k WHERE contains(low, k)),
w AS (SELECT doc_id, text, greatest(0, p0 - 30) AS a, least(length(text), p0 + 80) AS b FROM r),
f AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY doc_id, text ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM w),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, text ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM f),
m AS (SELECT doc_id, text, island, min(a) AS a, max(b) AS b FROM g GROUP BY doc_id, text, island),
j AS (SELECT doc_id, string_agg(substr(text, a::BIGINT + 1, (b - a)::BIGINT), chr(10) || chr(10) ORDER BY a) AS t FROM m GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(j.t, '')) AS windows, length(coalesce(j.t, '')) AS chars FROM d LEFT JOIN j USING (doc_id)""")
def win07_merged_windows(spark: SparkSession, sf: str) -> DataFrame:
    """WIN07: what stands around keywords in all documents, overlapping windows merged."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    d = d.select("doc_id", web.keyword_windows(F.col("text"), ("haan", "ción", "licensed"), 30, 80).alias("w"))
    return longs(d.select("doc_id", F.md5(F.col("w").cast("binary")).alias("windows"), F.length("w").alias("chars")))


# -- sheets -----------------------------------------------------------------------------------------


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    """A run for each nation, a citing paper for each of its customers, by key."""
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    context = F.transform(F.sequence(F.lit(1), (k % 3).cast("int")), lambda i: F.struct(_text("context ", i, " of ", k).alias("context"), F.lit(512).alias("context_window_size"), (i + 4).cast("int").alias("remark_score"), F.lit(None).cast("string").alias("reason")))
    contexts = F.when(k % 3 == 0, F.array().cast(tables.CONTEXT)).otherwise(context)
    author = F.struct(k.cast("string").alias("author_id"), _text("A", k).alias("name"), F.when(k % 4 == 0, F.lit("Inst")).alias("affiliation"), F.lit(None).cast("array<struct<id:string,display_name:string,ror:string,country_code:string>>").alias("institutions"), (k % 50).cast("int").alias("h_index"), F.when(k % 5 != 0, F.struct(F.lit("Yes").alias("ieee"), F.lit("No").alias("acm"), F.lit(None).cast("string").alias("aaai"))).alias("fellow_status"))
    remark = F.struct(F.col("c_name").alias("paper_title"), F.col("c_mktsegment").alias("venue"), (F.col("c_mktsegment") == "BUILDING").alias("has_fellow_topk"), _text("[", k, "] entry").alias("reference_entry"), F.lit("Unknown").alias("self_citation"), F.array(author).alias("topk_authors"), contexts.alias("contexts"))
    own = c.groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), remark.alias("r")))), lambda x: x["r"]).alias("cited_paper_remarks"))
    about = F.struct(F.col("n_name").alias("query_title"), _text("matched ", F.col("n_name")).alias("matched_title"), F.col("n_nationkey").cast("string").alias("paper_id"), F.lit(None).cast("string").alias("target_author"))
    return table(spark, sf, "nation").join(own, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("run_id"), about.alias("paper_to_analyze"), "cited_paper_remarks")


AUTHOR_SQL = "'A' || c_custkey || '(h_index=' || (c_custkey % 50) || CASE WHEN c_custkey % 4 = 0 THEN ', affiliation=Inst' ELSE '' END || CASE WHEN c_custkey % 5 != 0 THEN ', ieee=Yes, acm=No, aaai=' ELSE ', ieee=Unknown, acm=Unknown, aaai=Unknown' END || ')'"
PAPER_SQL = f"c_name || ' [SEP] venue=' || c_mktsegment || ' [SEP] fellow=' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'True' ELSE 'False' END || ' [SEP] topk_authors=[' || {AUTHOR_SQL} || ']'"


@query(f"""
SELECT n_name AS run_id, 'matched ' || n_name AS matched_title, count(*) AS citing_papers, sum(c_custkey % 3)::BIGINT AS contexts, count_if(c_custkey % 3 > 0)::BIGINT AS with_contexts, count_if(c_custkey % 3 = 0)::BIGINT AS without_contexts, bool_or(c_mktsegment = 'BUILDING') AS any_fellow,
  md5(string_agg({PAPER_SQL}, chr(10) ORDER BY c_custkey)) AS citing_agg, md5(coalesce(string_agg({PAPER_SQL}, chr(10) ORDER BY c_custkey) FILTER (c_mktsegment = 'BUILDING'), '')) AS citing_agg_fellow
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def agg09_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """AGG09, PRJ16: the target sheet."""
    out = reports.target_sheet(_summaries(spark, sf))
    digest = lambda c: F.md5(F.col(c).cast("binary")).alias(c)
    return longs(out.select("run_id", "matched_title", "citing_papers", "contexts", "with_contexts", "without_contexts", "any_fellow", digest("citing_agg"), digest("citing_agg_fellow")))


@query(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS paper_index, unnest(CASE WHEN c_custkey % 3 = 0 THEN [NULL] ELSE range(1, c_custkey % 3 + 1) END) AS i FROM customer)
SELECT n_name AS run_id, paper_index, c_name AS paper_title, c_mktsegment = 'BUILDING' AS fellow, {AUTHOR_SQL} AS topk_authors, '[' || c_custkey || '] entry' AS reference_entry, coalesce(i - 1, 0) AS context_index,
  CASE WHEN i IS NULL THEN 'None' ELSE 'context ' || i || ' of ' || c_custkey END AS context, (i + 4)::BIGINT AS remark_score, CASE WHEN i IS NULL THEN 'no_context' ELSE 'context' END AS row_type
FROM r JOIN nation ON c_nationkey = n_nationkey""")
def set08_outer_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """SET08, PRJ15: the context sheet; papers without contexts keep a row."""
    out = reports.context_sheet(_summaries(spark, sf))
    return longs(out.select("run_id", "paper_index", "paper_title", "fellow", "topk_authors", "reference_entry", "context_index", "context", "remark_score", "row_type"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY (o_totalprice < 1000), o_orderkey) - 1 AS place FROM orders")
def set06_stable_partition(spark: SparkSession, sf: str) -> DataFrame:
    """SET06: all orders, those with a fellow first."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("ord"), (F.col("o_totalprice") >= 1000).alias("has_fellow_topk"))
    return longs(works.numbered(reports.fellow_first(rows), "place").select("o_orderkey", "place"))


@query("""
WITH r AS (SELECT item_id, doc_id, doc_id // 40 AS k FROM benchmark JOIN documents ON doc_id % 40 = item_id % 40),
p AS (SELECT *, k // 40 AS page, k % 40 AS pos FROM r WHERE k // 40 < 3 AND k % 40 < 30), n AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY page, pos) - 1 AS rank FROM p)
SELECT item_id::VARCHAR AS query, rank, 'http://h/' || doc_id AS url FROM n WHERE rank < 80""")
def src13_ranked_results(spark: SparkSession, sf: str) -> DataFrame:
    """SRC13: the first results of the first pages of each query, in order."""
    d = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 40).alias("m"), F.floor(F.col("doc_id") / 40).alias("k"))
    raw = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query"), (F.col("item_id") % 40).alias("m")).join(d, "m")
    raw = raw.select("query", F.floor(F.col("k") / 40).alias("page"), (F.col("k") % 40).alias("pos"), _text("t", F.col("doc_id")).alias("title"), _text("http://h/", F.col("doc_id")).alias("href"))
    return longs(tables.search_results(raw, 3, 30, 80).select("query", "rank", "url"))


# -- lookups and counters ---------------------------------------------------------------------------


def _inputs(spark: SparkSession, sf: str) -> pipelines.Inputs:
    """Works with titles of their own; an order cites the order of its key's remainder by 50."""
    w = an.works(spark, sf).withColumn("paper_title", _text("Order study ", F.col("paper_id")))
    cites = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("citing_id"), (F.col("o_orderkey") % 50).cast("string").alias("cited_id"))
    none = spark.createDataFrame([], "paper_id string, text string")
    return pipelines.Inputs(w, cites, an.metrics(spark, sf), none, none, none)


@query(f"""WITH {an.SQL}, t AS (SELECT * FROM w WHERE ord % 50 = 7 ORDER BY cited_by_count DESC, year DESC, paper_id LIMIT 20)
SELECT t.paper_id, t.cited_by_count::BIGINT AS cited_by_count, coalesce(string_agg(a.author_id || ':' || coalesce(a.h::VARCHAR, 'null'), ',' ORDER BY a.pos), '') AS authors FROM t LEFT JOIN a USING (paper_id) GROUP BY t.paper_id, t.cited_by_count""")
def src26_cited_by_of_title(spark: SparkSession, sf: str) -> DataFrame:
    """SRC26, MATCH01, SRC03, JOI02: from a title to the works that cite it, with h-indexes."""
    out = pipelines.cited_by_of_title(_inputs(spark, sf), "order STUDY 7!", 20)
    authors = F.array_join(F.transform("authors", lambda a: _text(a["author_id"], ":", F.coalesce(a["h_index"].cast("string"), F.lit("null")))), ",")
    return longs(out.select("paper_id", "cited_by_count", authors.alias("authors")))


@query(f"WITH {an.SQL} SELECT paper_id, 'Order study ' || paper_id AS paper_title, year::BIGINT AS year, 1.0::DOUBLE AS match_score FROM w WHERE paper_id = '7'")
def src26_work_of_title(spark: SparkSession, sf: str) -> DataFrame:
    """SRC26, SRC02: from a title to the work."""
    out = pipelines.work_of_title(_inputs(spark, sf), "Order study: 7")
    return longs(out.select("paper_id", "paper_title", "year", "match_score"))


@query("""
WITH c AS (SELECT o_orderkey, year(o_orderdate) AS y, row_number() OVER (ORDER BY floor(o_totalprice)::INT DESC, year(o_orderdate) DESC, o_orderkey::VARCHAR) AS r FROM orders WHERE o_orderkey % 50 = 7)
SELECT count_if(r <= 30)::BIGINT AS top_cited_count, count_if(y BETWEEN 1996 AND 1997)::BIGINT AS recent_year_count, count_if(r <= 30 OR y BETWEEN 1996 AND 1997)::BIGINT AS merged_total, count_if(r <= 30 AND y BETWEEN 1996 AND 1997)::BIGINT AS duplicates_dropped FROM c""")
def agg13_recall_counters(spark: SparkSession, sf: str) -> DataFrame:
    """AGG13, SET01: what the recalls found, and how much of it twice."""
    return longs(pipelines.recall_counters(_inputs(spark, sf), Params(title="x", cited_by_top=30, recent_years=2, as_of_year=1997), "7"))
