"""Queries of shaping, text functions, orders, statuses and the knowledge graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import honors, knowledge, status, works
from ..session import table
from . import analogues as an
from . import pipelines
from .matching import TITLE_NORM, _text
from .registry import _enriched, longs, query


def none() -> Column:
    return F.lit(None).cast("string")

# -- shaping ----------------------------------------------------------------------------------------


@query("""
WITH o AS (SELECT *, o_orderkey AS k FROM orders),
a AS (SELECT l_orderkey AS k, string_agg('A' || l_suppkey, ',' ORDER BY l_linenumber, l_suppkey) AS authors,
  string_agg(CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'Inst ' || (l_suppkey % 7) || CASE WHEN l_suppkey % 2 = 0 THEN ' | country=C' || (l_suppkey % 5) ELSE '' END END, ';' ORDER BY l_linenumber, l_suppkey) AS institutions FROM lineitem GROUP BY l_orderkey)
SELECT 'W' || k AS paper_id, CASE WHEN k % 3 = 0 THEN 'plain title ' || k ELSE 'Title ' || k END AS paper_title, CASE WHEN k % 2 = 0 THEN 'doi ' || k ELSE 'ids ' || k END AS paper_doi, year(o_orderdate)::BIGINT AS year, floor(o_totalprice)::BIGINT AS cited_by_count,
  CASE WHEN k % 4 = 0 THEN 'Source ' || (k % 9) WHEN k % 4 = 1 THEN 'Host ' || (k % 9) WHEN k % 4 = 2 THEN 'Plain ' || (k % 9) END AS venue,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 'on ' || o_orderpriority || ' on end' END AS abstract, coalesce(a.authors, '') AS authors, coalesce(a.institutions, '') AS institutions
FROM o LEFT JOIN a USING (k)""")
def prj01_normalized_works(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ01, PRJ02, PRJ04, PRJ14, TXT07, TXT10: raw works of a scholarly graph as works."""
    k, s = F.col("o_orderkey"), F.col("l_suppkey")
    place = F.struct(_text("https://i.org/I", s).alias("id"), F.when(s % 3 == 0, " ").otherwise(_text("Inst ", s % 7)).alias("display_name"), none().alias("ror"), F.when((s % 3 != 0) & (s % 2 == 0), _text("C", s % 5)).alias("country_code"))
    blank = F.struct(none().alias("id"), F.lit(" ").alias("display_name"), none().alias("ror"), none().alias("country_code"))
    author = F.struct(
        F.col("l_linenumber").alias("n"), s.alias("s"),
        F.struct(_text("https://x.org/A", s, "/").alias("id"), _text("Name ", s).alias("display_name"), none().alias("orcid"), F.struct(none().alias("orcid")).alias("ids")).alias("author"),
        F.lit("middle").alias("author_position"), F.lit(False).alias("is_corresponding"), F.when(s % 3 == 0, F.array(blank)).otherwise(F.array(blank, place)).alias("institutions"),
    )
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(author)).alias("authorships"))
    o = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    name = lambda c: F.struct(c.alias("display_name"), none().alias("name"))
    words = F.map_from_arrays(F.array(F.col("o_orderpriority"), F.lit("on"), F.lit("end")), F.array(F.array(F.lit(1)), F.array(F.lit(0), F.lit(2)), F.array(F.lit(3))))
    raw = o.select(
        F.when(k % 2 == 0, _text("https://x.org/W", k)).alias("openalex_id"), _text("W", k).alias("id"), F.when(k % 3 != 0, _text("Title ", k)).alias("display_name"), _text("plain title ", k).alias("title"),
        F.when(k % 2 == 0, _text("doi ", k)).alias("doi"), F.struct(_text("ids ", k).alias("doi")).alias("ids"), F.year("o_orderdate").alias("publication_year"), F.floor("o_totalprice").alias("cited_by_count"),
        F.struct(name(F.when(k % 4 == 0, _text("Source ", k % 9)).otherwise(" ")).alias("source")).alias("primary_location"), name(F.when(k % 4 <= 1, _text("Host ", k % 9))).alias("host_venue"), F.when(k % 4 <= 2, _text("Plain ", k % 9)).alias("venue"),
        F.when(k % 5 != 0, words).alias("abstract_inverted_index"), F.coalesce("authorships", F.array().cast(lines.schema["authorships"].dataType)).alias("authorships"),
    )
    w = works.normalized_works(raw)
    shown = F.array_join(F.transform("authors", lambda a: a["author_id"]), ",")
    places = F.array_join(F.transform("authors", lambda a: F.regexp_replace(works.institutions_text(a["institutions"]), r"ror=[^|]* \| ", "")), ";")
    return longs(w.select("paper_id", "paper_title", "paper_doi", "year", "cited_by_count", "venue", "abstract", shown.alias("authors"), places.alias("institutions")))


@query("""
SELECT 'A' || s_suppkey AS author_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE 'ids' END AS orcid, CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE floor(abs(s_acctbal) / 100)::BIGINT + 1 END::BIGINT AS h_index,
  (s_suppkey * 3) AS works_count, CASE WHEN s_suppkey % 4 = 0 THEN 'Second' WHEN s_suppkey % 4 = 1 THEN 'Named' END AS affiliation FROM supplier""")
def prj03_author_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ03, PRJ13: raw authors as profiles; a blank place gives way to the next."""
    k = F.col("s_suppkey")
    place = lambda shown, plain: F.struct(F.struct(shown.alias("display_name"), plain.alias("name")).alias("institution"))
    places = F.array(place(F.lit(" "), F.when(k % 4 == 1, "Named")), place(F.when(k % 4 == 0, "Second"), none()))
    raw = table(spark, sf, "supplier").select(
        none().alias("openalex_id"), _text("http://x.org/A", k).alias("id"), F.col("s_name").alias("display_name"), F.when(k % 2 == 0, "own").alias("orcid"), F.struct(F.lit("ids").alias("orcid")).alias("ids"),
        F.struct(F.when(k % 3 == 0, 0).otherwise(F.floor(F.abs("s_acctbal") / 100) + 1).cast("int").alias("h_index")).alias("summary_stats"), F.lit(7).alias("h_index"),
        (k * 3).alias("works_count"), F.lit(0).alias("cited_by_count"), places.alias("affiliations"),
    )
    return longs(works.author_profile(works.normalized_authors(raw)).select("author_id", "name", "orcid", "h_index", "works_count", "affiliation"))


@query(f"WITH {an.SQL} SELECT w.paper_id, w.paper_title, max(a.h)::BIGINT AS max_h_index, count(a.author_id) AS authors FROM w LEFT JOIN a USING (paper_id) GROUP BY w.paper_id, w.paper_title")
def prj07_candidate_summary(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ07: works with slim authors and the highest h-index."""
    rows = _enriched(spark, sf).withColumns({"paper_doi": none(), "venue": none()})
    return longs(works.candidate_summary(rows).select("paper_id", "paper_title", "max_h_index", F.size("authors").alias("authors")))


# -- texts ------------------------------------------------------------------------------------------


@query(r"""
WITH d AS (SELECT doc_id, text, lower(text) AS low, 'https://x.org/a/' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '//' ELSE '' END AS url FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(trim(regexp_replace(low, '[\s\x0b]+', ' ', 'g'))) AS plain, doc_id::VARCHAR AS short_id, md5(CASE WHEN length(text) > 1200 THEN left(text, 1200) || '...<truncated>' ELSE text END) AS truncated,
  CASE WHEN regexp_replace(regexp_replace(trim(left(text, 60)), '[^a-zA-Z0-9._-]+', '_', 'g'), '^[_.-]+|[_.-]+$', '', 'g') = '' THEN 'unknown' ELSE left(regexp_replace(regexp_replace(trim(left(text, 60)), '[^a-zA-Z0-9._-]+', '_', 'g'), '^[_.-]+|[_.-]+$', '', 'g'), 20) END AS slug,
  len(list_filter(string_split_regex(lower(left(text, 80)), '[^\p{L}\p{N}_]+'), lambda w: length(w) > 1))::BIGINT AS name_tokens,
  len(string_split(substr(text, 1, 100), chr(10)))::BIGINT AS line, CASE doc_id % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS status,
  array_to_string(CASE WHEN doc_id % 3 = 0 THEN ['http://a.b/c?d=1', 'HTTPS://e.f'] ELSE [] END, ' ') AS urls,
  trim('Ann Lee ' || CASE WHEN doc_id % 2 = 0 THEN 'MIT ' ELSE '' END || 'faculty profile homepage') AS search_query,
  CASE WHEN doc_id % 11 <= 3 THEN 'neg' WHEN doc_id % 11 <= 6 THEN 'neutral' ELSE 'pos' END AS bucket
FROM d""")
def txt05_text_functions(spark: SparkSession, sf: str) -> DataFrame:
    """TXT05, TXT07, TXT09, TXT13, TXT16, TXT23, TXT29, TXT31, TXT34: functions of texts, one by one."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    k, t = F.col("doc_id"), F.col("text")
    md5 = lambda c: F.md5(c.cast("binary"))
    said = F.when(k % 4 == 0, " yes").when(k % 4 == 1, "NO ").when(k % 4 == 2, "maybe")
    told = F.when(k % 3 == 0, "see http://a.b/c?d=1) and \"HTTPS://e.f\"").otherwise("no link")
    return longs(d.select(
        "doc_id", md5(tx.plain_norm(t)).alias("plain"), tx.short_id(_text("https://x.org/a/", k, F.when(k % 2 == 0, "//").otherwise(""))).alias("short_id"), md5(tx.truncated(t)).alias("truncated"),
        tx.slug(F.left(t, F.lit(60)), 20).alias("slug"), F.size(tx.name_tokens(F.left(t, F.lit(80)))).alias("name_tokens"), tx.line_of(t, F.lit(100)).alias("line"), tx.status_norm(said).alias("status"),
        F.array_join(tx.urls_in(told), " ").alias("urls"), tx.search_query(F.lit("Ann  Lee"), F.when(k % 2 == 0, "MIT").otherwise(" "), none()).alias("search_query"), tx.score_bucket(k % 11).alias("bucket"),
    ))


@query(r"""
WITH d AS (SELECT doc_id, 'Head' || chr(13) || chr(10) || left(regexp_replace(text, '\s+', ' ', 'g'), 40) || '  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'tail line' || chr(10) || 'goes on ' || chr(10) AS t, trim(left(regexp_replace(text, '\s+', ' ', 'g'), 40)) AS mid, left(regexp_replace(text, '\s+', ' ', 'g'), 40) AS raw FROM documents WHERE text IS NOT NULL)
SELECT doc_id, 'Head' || chr(10) || rtrim(raw, ' ') || chr(10) || chr(10) || 'tail line' || chr(10) || 'goes on' AS markdown, trim('Head ' || mid) || chr(10) || chr(10) || 'tail line goes on' AS paragraphs FROM d""")
def txt17_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """TXT17, TXT18: Markdown and wrapped text in order."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    t = _text("Head\r\n", F.left(F.regexp_replace("text", r"\s+", " "), F.lit(40)), "  \n\n\n\ntail line\ngoes on \n")
    return d.select("doc_id", tx.markdown_norm(t).alias("markdown"), tx.paragraphs(t).alias("paragraphs"))


@query("""
SELECT p_partkey, string_agg(w, '|' ORDER BY i) AS kept FROM (SELECT p_partkey, w, min(i) AS i FROM (SELECT p_partkey, unnest(['a' || (p_partkey % 3), p_brand, 'a' || (p_partkey % 2), p_brand, 'z']) AS w, unnest(range(5)) AS i FROM part) GROUP BY p_partkey, w) GROUP BY p_partkey""")
def set02_distinct_texts(spark: SparkSession, sf: str) -> DataFrame:
    """SET02: a list's texts, stripped, without blanks and repeats, in order."""
    k = F.col("p_partkey")
    items = F.array(_text(" a", k % 3), F.col("p_brand"), F.lit("  "), _text("a", k % 2, " "), F.col("p_brand"), none(), F.lit("z"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.distinct_texts(items), "|").alias("kept"))


# -- orders and statuses ----------------------------------------------------------------------------


@query(f"""WITH {an.SQL} SELECT w.paper_id, row_number() OVER (ORDER BY m.max_h DESC NULLS LAST, w.cited_by_count DESC, w.year DESC, w.paper_title, w.ord) - 1 AS place FROM w JOIN (SELECT w2.paper_id, max(a.h) AS max_h FROM w w2 LEFT JOIN a USING (paper_id) GROUP BY w2.paper_id) m ON m.paper_id = w.paper_id""")
def srt03_phase_one_order(spark: SparkSession, sf: str) -> DataFrame:
    """SRT03: all works by highest h-index, those without one last."""
    rows = _enriched(spark, sf).select("paper_id", "paper_title", "year", "cited_by_count", "ord", works.max_h_index(F.col("authors")).alias("max_h_index"))
    return longs(works.numbered(rows.orderBy(*works.phase_one_order(), "ord"), "place").select("paper_id", "place"))


@query(rf"""
WITH q AS (SELECT p_partkey, p_name || ' ' || p_brand AS t FROM part), c AS (SELECT p_partkey, t, i AS pos, t || repeat(' more', ((p_partkey + i) % 4)::INT) AS title FROM q, range(4) r(i)),
s AS (SELECT p_partkey, pos, 2.0 * length({TITLE_NORM.format("t")}) / (length({TITLE_NORM.format("t")}) + length({TITLE_NORM.format("title")})) AS score FROM c)
SELECT p_partkey, pos, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, pos) AS place FROM s""")
def srt09_scored_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """SRT09: all candidates of each query, best first."""
    from pyspark.sql import Window

    k = F.col("p_partkey")
    q = table(spark, sf, "part").select(k, k.alias("query_id"), _text(F.col("p_name"), " ", F.col("p_brand")).alias("query_title"))
    titles = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat(F.col("query_title"), F.repeat(F.lit(" more"), ((k + i) % 4).cast("int"))))
    rows = status.score_candidates(q.select("*", F.posexplode(titles).alias("pos", "candidate_title")))
    return longs(rows.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "pos"))).select("p_partkey", "pos", "place"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '10.5/' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'x/' || o_orderkey END AS doi FROM orders WHERE o_orderstatus = 'F'")
def flt01_published(spark: SparkSession, sf: str) -> DataFrame:
    """FLT01, PRJ08: published works, and the DOI of a field or a link."""
    k = F.col("o_orderkey")
    links = F.when(k % 3 == 1, F.array(F.lit("http://other/1"), _text("https://doi.org/x/", k, " "), F.lit("https://doi.org/no"))).otherwise(F.array(F.lit("u")))
    s = F.struct(F.when(F.col("o_orderstatus") == "F", "Published").otherwise("informal").alias("status"), status.doi_of(F.when(k % 3 == 0, _text(" 10.5/", k)).otherwise(" "), links).alias("doi"))
    return status.published(table(spark, sf, "orders").select("o_orderkey", s.alias("publication_status"))).select("o_orderkey", "publication_status.doi")


@query(f"""WITH {an.SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY coalesce(h, 0) DESC, name, pos) AS n FROM a)
SELECT w.paper_id, coalesce(bool_or(l_suppkey % 8 = 0 OR l_suppkey % 12 = 3) FILTER (n <= 2), false) AS has_fellow, count(l_suppkey) FILTER (n <= 2 AND l_suppkey % 5 = 0) AS unknown FROM w LEFT JOIN k USING (paper_id) GROUP BY w.paper_id""")
def agg10_with_fellows(spark: SparkSession, sf: str) -> DataFrame:
    """AGG10, WIN02: statuses of the top authors of every work, and whether one is a fellow."""
    rows = _enriched(spark, sf).withColumn("topk_authors", works.top_authors(F.col("authors"), 2))
    k = F.col("s_suppkey")
    said = F.struct(F.when(k % 8 == 0, "Yes").otherwise("No").alias("ieee"), F.lit("Unknown").alias("acm"), F.when(k % 12 == 3, "Yes").otherwise("Unknown").alias("aaai"))
    fellows = F.when((k % 5 != 0) | (k % 8 == 0) | (k % 12 == 3), said)
    statuses = table(spark, sf, "supplier").select(k.cast("string").alias("author_id"), fellows.alias("statuses"), F.array(F.lit("s")).alias("sources")).where(F.col("statuses").isNotNull())
    out = honors.with_fellows(rows, statuses)
    fifth = F.size(F.filter("topk_authors", lambda a: a["author_id"].cast("long") % 5 == 0))
    return longs(out.select("paper_id", F.col("has_fellow_topk").alias("has_fellow"), F.coalesce(fifth, F.lit(0)).alias("unknown")))


@query("""
WITH e AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS m, CASE event_id // 3 % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS r, event_id % 7 > 0 AND event_id % 5 > 0 AS ok FROM events),
g AS (SELECT event_id, r, CASE WHEN ok THEN m ELSE 'Unknown' END AS m FROM e)
SELECT event_id, m AS model, CASE WHEN r = 'Yes' THEN 'Yes' WHEN r = 'No' AND m = 'Unknown' THEN 'No' ELSE m END AS merged FROM g""")
def agg12_merged_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """AGG12, LLM03, TXT25: replies in JSON, gated, and how a rule's status merges with them."""
    k = F.col("event_id")
    word = lambda n: F.when(n == 0, "Yes").when(n == 1, "No").otherwise("Unknown")
    reply = _text("Sure: {\"is_target_scholar\": ", F.when(k % 7 > 0, "true").otherwise("false"), ", \"has_valid_profile_content\": ", F.when(k % 5 > 0, "\"yes\"").otherwise("0"), ", \"fellow\": {\"ACM Fellow\": {\"status\": \"", F.lower(word(k % 3)), "\"}}}")
    e = table(spark, sf, "events").select("event_id", honors.reply_statuses(reply)["acm"].alias("model"), word(F.floor(k / 3) % 3).alias("rule"))
    return e.select("event_id", "model", honors.merged_status(F.col("model"), F.col("rule")).alias("merged"))


@query("SELECT count(*) AS context_attempted, count_if(o_orderkey % 4 IN (1, 2))::BIGINT AS context_ref_id_found FROM orders")
def agg14_context_counters(spark: SparkSession, sf: str) -> DataFrame:
    """AGG14: how many papers had an entry; an id of 0 counts as none."""
    k = F.col("o_orderkey")
    return longs(pipelines.context_counters(table(spark, sf, "orders").select(F.when(k % 4 < 3, (k % 4).cast("int")).alias("ref_id"))))


# -- knowledge graph --------------------------------------------------------------------------------


def _people(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Search hits, entities and labels: each supplier has three hits; nations are organisations."""
    s = table(spark, sf, "supplier")
    k, pos = F.col("s_suppkey"), F.col("pos")
    hits = s.select(k.cast("string").alias("author_key"), _text("Univ NATION_", F.col("s_nationkey"), " Dept").alias("affiliation"), k, F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos"))
    hits = hits.select("author_key", "affiliation", pos.alias("rank"), _text("P", k, "_", pos).alias("qid"))
    one = lambda c: F.array(c)
    claims = F.map_from_arrays(
        F.array(F.lit("P31"), F.lit("P108"), F.lit("P166")),
        F.array(one(F.when((k + pos) % 3 == 0, "Q9").otherwise("Q5")), one(_text("N", F.when(pos == 2, F.col("s_nationkey")).otherwise(99))), F.when(k % 2 == 0, F.array(F.lit("W1"), F.lit("W2"))).otherwise(one(F.lit("W3")))),
    )
    entities = s.select(k, "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos")).select(_text("P", k, "_", pos).alias("qid"), claims.alias("claims"))
    names = table(spark, sf, "nation").select(_text("N", F.col("n_nationkey")).alias("qid"), F.create_map(F.lit("zh"), F.col("n_name")).alias("labels"))
    awards = spark.createDataFrame([("W1", {"en": "ACM Fellow"}), ("W2", {"fr": "Prix"})], "qid string, labels map<string,string>")
    labels = names.unionByName(awards).withColumn("aliases", F.lit(None).cast("map<string,array<string>>"))
    return hits, entities, labels


@query("""
WITH h AS (SELECT s_suppkey, pos, (s_suppkey + pos) % 3 != 0 AS human, pos = 2 AS met FROM supplier, range(3) r(pos)),
b AS (SELECT *, CASE WHEN human AND met THEN 0 WHEN human THEN 1 ELSE 2 END AS level FROM h), p AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY level, pos) AS n FROM b)
SELECT s_suppkey::VARCHAR AS author_key, 'P' || s_suppkey || '_' || pos AS qid, CASE level WHEN 0 THEN 'affiliation' WHEN 1 THEN 'human' ELSE 'first_hit' END AS matched FROM p WHERE n = 1""")
def ext17_author_entities(spark: SparkSession, sf: str) -> DataFrame:
    """EXT17, JOI13, SRC25: which entity of a knowledge graph an author is."""
    return knowledge.author_entities(*_people(spark, sf))


@query("""SELECT s_suppkey::VARCHAR AS author_key, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS awards, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS matching FROM supplier""")
def ext18_award_totals(spark: SparkSession, sf: str) -> DataFrame:
    """EXT18, AGG15: awards of the people found, and those that are fellowships."""
    hits, entities, labels = _people(spark, sf)
    people = knowledge.author_entities(hits, entities, labels)
    return longs(knowledge.award_totals(knowledge.awards(people, entities, labels)))
