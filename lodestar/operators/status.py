"""Title matching and publication status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx

#: The bibliography's types of peer-reviewed works, and its name for preprints.
REVIEWED = ("Journal Articles", "Conference and Workshop Papers")
INFORMAL = "Informal and Other Publications"
PREPRINTS = "CoRR"


def candidates_by_token(queries: DataFrame, titles: DataFrame, per_query: int, least_tokens: int = 1) -> DataFrame:
    """(query_id, pos, ...) pairs that share words, the per_query with most shared words: what a title
    search returns. Common words, those in over a tenth of the titles, link nothing unless a query has
    no others; they count where two titles meet by another word."""
    words = lambda c: F.array_distinct(F.filter(F.split(tx.title_norm(c), " "), lambda w: w != ""))
    q = queries.select("query_id", words(F.col("query_title")).alias("qw"))
    t = titles.select("paper_id", words(F.col("paper_title")).alias("tw"))
    by_word = t.select("paper_id", F.explode("tw").alias("w"))
    # at most ten times as many as a title has words on average
    common = by_word.groupBy("w").agg(F.count("*").alias("n")).join(F.broadcast(t.agg((F.count("*") / 10).alias("most"))), F.col("n") > F.col("most")).select("w", F.lit(True).alias("common"))
    asked = q.select("query_id", F.explode("qw").alias("w")).join(F.broadcast(common), "w", "left")
    only = asked.groupBy("query_id").agg(F.bool_and(F.coalesce("common", F.lit(False))).alias("only"))
    links = asked.join(only, "query_id").where(F.col("common").isNull() | F.col("only")).select("query_id", "w")
    pairs = links.join(by_word, "w").select("query_id", "paper_id").distinct()
    met = pairs.join(q, "query_id").join(t, "paper_id").withColumn("shared", F.size(F.array_intersect("qw", "tw"))).where(F.col("shared") >= least_tokens).select("query_id", "paper_id", "shared")
    place = Window.partitionBy("query_id").orderBy(F.desc("shared"), "paper_id")
    return met.withColumn("pos", F.row_number().over(place) - 1).where(F.col("pos") < per_query)


def scored(pairs: DataFrame, a: str, b: str, out: str = "score") -> DataFrame:
    """pairs with the ratio of two columns. Equal pairs are compared once, equal strings not at all."""
    distinct = pairs.select(a, b).where(F.col(a) != F.col(b)).distinct().withColumn(out, sim.ratio(F.col(a), F.col(b)))
    return pairs.join(distinct, [a, b], "left").withColumn(out, F.when(F.col(a) == F.col(b), F.when(F.col(a) == "", 0.0).otherwise(1.0)).otherwise(F.col(out)))


def best_title_match(pairs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Of (query_id, query_title, pos, candidate_title, ...) the best candidate of each query: highest
    ratio above 0, the first among equals; is_confident tells whether it reaches the threshold."""
    rows = pairs.withColumns({"__a": tx.title_norm(F.coalesce("query_title", F.lit(""))), "__b": tx.title_norm(F.coalesce("candidate_title", F.lit("")))})
    rows = scored(rows, "__a", "__b").where(F.col("score") > 0)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "pos")
    return rows.withColumn("__n", F.row_number().over(place)).where("__n = 1").drop("__n", "__a", "__b").withColumn("is_confident", F.col("score") >= threshold)


def score_candidates(pairs: DataFrame) -> DataFrame:
    """All candidates with their ratio, best first, input order among equals."""
    rows = pairs.withColumns({"__a": tx.title_norm(F.coalesce("query_title", F.lit(""))), "__b": tx.title_norm(F.coalesce("candidate_title", F.lit("")))})
    return scored(rows, "__a", "__b").drop("__a", "__b").orderBy("query_id", F.desc("score"), "pos")


def doi_of(doi: Column, links: Column) -> Column:
    """The DOI given, else what follows doi.org/ in the first link that has it."""
    linked = F.try_element_at(F.filter(links, lambda u: F.contains(u, F.lit("doi.org/"))), F.lit(1))
    return F.coalesce(tx.blank_to_null(doi), F.trim(F.element_at(F.split(linked, r"doi\.org/"), -1)))


def links_of(ee: Column) -> Column:
    """Links of a field that holds a string, an object with `text`, or a list of either (as JSON)."""
    t = F.trim(ee)
    items = F.when(t.startswith("["), F.from_json(t, "array<string>")).when(t.isNotNull() & (t != ""), F.array(t))
    plain = F.transform(items, lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.text")).otherwise(F.regexp_replace(x, '^"|"$', "")))
    return F.coalesce(F.filter(plain, lambda x: tx.blank_to_null(x).isNotNull()), F.array().cast("array<string>"))


def hits_of(raw: Column) -> Column:
    """The hits of a search answer (JSON), which may be a list, one object or missing."""
    hit = F.get_json_object(raw, "$.result.hits.hit")
    return F.coalesce(F.when(hit.startswith("["), F.from_json(hit, "array<string>")).when(hit.startswith("{"), F.array(hit)), F.array().cast("array<string>"))


def hit_rows(answers: DataFrame) -> DataFrame:
    """(query_title, pos, score, title, venue, year, type, url, doi, links) of raw answers."""
    rows = answers.select("query_title", F.posexplode(hits_of(F.col("answer"))).alias("pos", "h"))
    info = lambda k: F.get_json_object("h", f"$.info.{k}")
    return rows.select("query_title", "pos", F.coalesce(F.get_json_object("h", "$['@score']").try_cast("int"), F.lit(0)).alias("hit_score"), *[info(k).alias(k) for k in ("title", "venue", "year", "type", "url", "doi")], links_of(info("ee")).alias("links"))


def publication_status(titles: DataFrame, hits: DataFrame, least: float = 0.92) -> DataFrame:
    """Status of each title of `titles` (query_title): published if a peer-reviewed hit is similar
    enough, else informal, else unknown. Hits that lengths rule out are never compared."""
    q = sim.with_bibliography_norm(titles.select("query_title").distinct(), "query_title", "__q")
    h = sim.with_bibliography_norm(hits, "title", "__t")
    pairs = h.join(q, "query_title").where((F.col("__q") != "") & (F.col("__t") != "") & (sim.best_possible(F.col("__q"), F.col("__t")) >= least))
    close = scored(pairs, "__q", "__t", "similarity").where(F.col("similarity") >= least)
    reviewed = F.col("type").isin(*REVIEWED) & F.coalesce(F.col("venue") != PREPRINTS, F.lit(True))
    informal = (F.col("type") == INFORMAL) | (F.col("venue") == PREPRINTS)
    kind = F.when(reviewed, 0).when(informal, 1).otherwise(2)
    order = [F.col("kind"), F.desc("similarity"), F.desc("hit_score"), F.coalesce(F.col("year").try_cast("int"), F.lit(0)).desc(), F.col("pos")]
    best = close.withColumn("kind", kind).withColumn("__n", F.row_number().over(Window.partitionBy("query_title").orderBy(*order))).where("__n = 1")
    found = best.select(
        "query_title",
        F.struct(
            F.when(F.col("kind") == 0, "published").when(F.col("kind") == 1, "informal").otherwise("unknown").alias("status"),
            F.col("venue"), F.col("year"), F.col("url").alias("dblp_url"), doi_of(F.col("doi"), F.col("links")).alias("doi"),
            F.col("similarity"), F.col("type").alias("pub_type"),
        ).alias("publication_status"),
    )
    unknown = F.struct(F.lit("unknown").alias("status"), *[F.lit(None).cast("string").alias(c) for c in ("venue", "year", "dblp_url", "doi")], F.lit(None).cast("double").alias("similarity"), F.lit(None).cast("string").alias("pub_type"))
    return titles.join(found, "query_title", "left").withColumns({"status_error": F.when(F.col("publication_status").isNull(), "no_match"), "publication_status": F.coalesce("publication_status", unknown)})


def published(works: DataFrame) -> DataFrame:
    return works.where(F.lower(F.col("publication_status.status")) == "published")


def status_counts(works: DataFrame) -> DataFrame:
    """published, informal, unknown (anything else too) and errors."""
    s = F.lower(F.col("publication_status.status"))
    return works.agg(F.count_if(s == "published").alias("published"), F.count_if(s == "informal").alias("informal"), F.count_if(~F.coalesce(s.isin("published", "informal"), F.lit(False))).alias("unknown"), F.count_if(F.col("status_error").isNotNull()).alias("errors"))
