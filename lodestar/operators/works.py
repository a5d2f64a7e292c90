"""Works and their authors: shaping, recall, enrichment, filters, ranking and selection.

Works carry `authors`, an array of structs in author order; short arrays are worked on in place, so
only the enrichment join shuffles. Input order, where it matters, is the column `ord`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import cut

INSTITUTION = "struct<id:string,display_name:string,ror:string,country_code:string>"
#: Which columns each use of a work needs: Spark prunes the rest at the scan.
FIELDS = {
    "match": ["paper_id", "paper_title", "year", "cited_by_count"],
    "cited_by": ["paper_id", "paper_title", "paper_doi", "year", "cited_by_count", "venue", "authors"],
    "meta": ["paper_id", "paper_title", "paper_doi", "year", "cited_by_count", "venue", "abstract"],
    "author": ["author_id", "name", "orcid", "h_index", "works_count", "cited_by_count", "affiliation"],
}


def projected(df: DataFrame, use: str) -> DataFrame:
    """The columns of a use that df has, in their order."""
    return df.select(*[c for c in FIELDS[use] if c in df.columns])


# -- shaping ------------------------------------------------------------------------------------


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[tx.blank_to_null(c) for c in columns])


def institutions(items: Column) -> Column:
    """Institutions with short ids; those with nothing filled are dropped."""
    shaped = F.transform(items, lambda i: F.struct(tx.short_id(i["id"]).alias("id"), tx.blank_to_null(i["display_name"]).alias("display_name"), tx.blank_to_null(i["ror"]).alias("ror"), tx.blank_to_null(i["country_code"]).alias("country_code")))
    return F.filter(shaped, lambda i: F.coalesce(i["id"], i["display_name"], i["ror"], i["country_code"]).isNotNull())


def named_institutions(names: Column) -> Column:
    """Institutions of bare names."""
    none = F.lit(None).cast("string")
    return F.transform(F.filter(names, lambda n: tx.blank_to_null(n).isNotNull()), lambda n: F.struct(none.alias("id"), F.trim(n).alias("display_name"), none.alias("ror"), none.alias("country_code")))


def affiliation_of(items: Column) -> Column:
    """The first institution's name that is not blank."""
    named = F.filter(items, lambda i: tx.blank_to_null(i["display_name"]).isNotNull())
    return F.trim(F.try_element_at(named, F.lit(1))["display_name"])


def institutions_text(items: Column) -> Column:
    one = lambda i: F.concat_ws(" | ", i["display_name"], F.when(i["ror"].isNotNull(), F.concat(F.lit("ror="), i["ror"])), F.when(i["country_code"].isNotNull(), F.concat(F.lit("country="), i["country_code"])))
    return F.array_join(F.filter(F.transform(items, one), lambda s: s != ""), "; ")


def venue_of() -> Column:
    """The first venue that is filled: of the primary location's source, the host, then the plain one."""
    return first_filled(F.col("primary_location.source.display_name"), F.col("primary_location.source.name"), F.col("host_venue.display_name"), F.col("host_venue.name"), F.col("venue"))


def normalized_works(raw: DataFrame) -> DataFrame:
    """Raw scholarly-graph works as works."""
    author = lambda a: F.struct(
        tx.short_id(a["author"]["id"]).alias("author_id"),
        a["author"]["display_name"].alias("name"),
        F.coalesce(a["author"]["orcid"], a["author"]["ids"]["orcid"]).alias("orcid"),
        a["author_position"].alias("author_position"),
        a["is_corresponding"].alias("is_corresponding"),
        F.coalesce(institutions(a["institutions"]), F.array().cast(f"array<{INSTITUTION}>")).alias("institutions"),
        F.lit(None).cast("int").alias("h_index"),
        F.lit(None).cast("string").alias("affiliation"),
    )
    return raw.select(
        tx.short_id(F.coalesce("openalex_id", "id")).alias("paper_id"),
        F.coalesce("display_name", "title").alias("paper_title"),
        F.coalesce("doi", "ids.doi").alias("paper_doi"),
        F.col("publication_year").cast("int").alias("year"),
        F.col("cited_by_count").cast("int").alias("cited_by_count"),
        venue_of().alias("venue"),
        F.coalesce(F.transform("authorships", author), F.array()).alias("authors"),
        tx.inverted_index_text(F.col("abstract_inverted_index")).alias("abstract"),
    )


def with_aliases(works: DataFrame) -> DataFrame:
    """Works with the upstream names of their columns beside their own."""
    return works.withColumns({"openalex_id": F.col("paper_id"), "id": F.col("paper_id"), "display_name": F.col("paper_title"), "doi": F.col("paper_doi"), "publication_year": F.col("year")})


def normalized_authors(raw: DataFrame) -> DataFrame:
    """Raw authors; an h-index of 0 in the statistics gives way to the plain one."""
    places = F.filter("affiliations", lambda a: first_filled(a["institution"]["display_name"], a["institution"]["name"]).isNotNull())
    place = F.try_element_at(places, F.lit(1))["institution"]
    return raw.select(
        tx.short_id(F.coalesce("openalex_id", "id")).alias("author_id"),
        F.col("display_name").alias("name"),
        F.coalesce("orcid", "ids.orcid").alias("orcid"),
        F.coalesce(F.nullif(F.col("summary_stats.h_index"), F.lit(0)), F.col("h_index")).cast("int").alias("h_index"),
        F.col("works_count").cast("long").alias("works_count"),
        F.col("cited_by_count").cast("long").alias("cited_by_count"),
        first_filled(place["display_name"], place["name"]).alias("affiliation"),
    )


def author_profile(authors: DataFrame) -> DataFrame:
    """What is shown of an author."""
    return authors.select("author_id", "name", "orcid", "affiliation", "h_index", "works_count", "cited_by_count")


def candidate_summary(works: DataFrame) -> DataFrame:
    """Works with slim authors and the highest h-index."""
    slim = F.transform("authors", lambda a: F.struct(a["author_id"].alias("author_id"), a["name"].alias("name"), a["h_index"].alias("h_index")))
    return works.select("paper_id", "paper_title", "paper_doi", "year", "cited_by_count", "venue", max_h_index(F.col("authors")).alias("max_h_index"), slim.alias("authors"))


def with_h_index_defaults(works: DataFrame) -> DataFrame:
    return works.withColumn("authors", F.transform("authors", lambda a: a.withField("h_index", F.coalesce(a["h_index"], F.lit(0)))))


# -- recall -------------------------------------------------------------------------------------


def citing(works: DataFrame, citations: DataFrame, target: str) -> DataFrame:
    """Works that cite the target."""
    ids = citations.where(F.col("cited_id") == target).select(F.col("citing_id").alias("paper_id")).distinct()
    return works.join(ids, "paper_id", "left_semi")


def most_cited(works: DataFrame, k: int) -> DataFrame:
    return works.orderBy(F.desc("cited_by_count"), F.desc("year"), "paper_id").limit(max(0, k))


def in_years(works: DataFrame, from_year: int | None = None, to_year: int | None = None) -> DataFrame:
    """Works of some years; either end may be open, a reversed range is empty."""
    keep = F.lit(True)
    if from_year is not None:
        keep = keep & (F.col("year") >= from_year)
    if to_year is not None:
        keep = keep & (F.col("year") <= to_year)
    return works.where(keep)


def top_cited(works: DataFrame, citations: DataFrame, target: str, k: int) -> DataFrame:
    """The k most cited works that cite the target; ties by year, then id."""
    return most_cited(citing(works, citations, target), k)


def recent_citing(works: DataFrame, citations: DataFrame, target: str, from_year: int | None = None, to_year: int | None = None) -> DataFrame:
    """Works of some years that cite the target; either end may be open, a reversed range is empty."""
    return citing(in_years(works, from_year, to_year), citations, target)


def cutoff_year(as_of_year: int, last_years: int) -> int:
    return as_of_year - last_years + 1


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Sorted rows with their place from 0. Places come from the sizes of the sorted partitions, of which
    there is one row each; the rows are never in one task. They are written once, so that the borders
    of partitions stay what they were."""
    at = rows.withColumn("__m", F.monotonically_increasing_id())
    at = cut(at.withColumns({"__p": F.shiftright("__m", 33), "__i": F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__m"))
    sizes = at.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__b", F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).select("__p", F.coalesce("__b", F.lit(0)).alias("__b"))
    return at.join(F.broadcast(before), "__p").withColumn(name, F.col("__b") + F.col("__i")).drop("__p", "__i", "__b")


def merged_recalls(*recalls: tuple[str, DataFrame], key: str = "paper_id", order: str = "ord") -> DataFrame:
    """Recalls as one set: a row for each key, as its first recall has it, with the names of all its
    recalls in order. Rows without a key stay apart. One aggregation; rows travel once. `ord` tells the
    order: the recall, the place in it and the key, as a struct that compares in that order."""
    parts = [df.withColumns({"__recall": F.lit(i), "recall_sources": F.array(F.lit(name))}) for i, (name, df) in enumerate(recalls)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    columns = [c for c in both.columns if c not in ("__recall", "recall_sources", key)]
    place = F.struct("__recall", order)
    first = F.min_by(F.struct(*columns), place)
    sources = F.array_sort(F.collect_set(F.struct("__recall", F.col("recall_sources")[0].alias("s"))))
    keyed = both.where(F.col(key).isNotNull()).groupBy(key).agg(first.alias("r"), sources.alias("s"), F.min(place).alias("at"))
    keyed = keyed.select(key, "r.*", F.transform("s", lambda x: x["s"]).alias("recall_sources"), "at")
    loose = both.where(F.col(key).isNull()).withColumn("at", place).drop("__recall").select(*keyed.columns)
    return keyed.unionByName(loose).withColumn("ord", F.struct(F.col("at.__recall").alias("recall"), F.col(f"at.{order}").alias("place"), F.col(key).alias("key"))).drop("at")


# -- authors ------------------------------------------------------------------------------------


def bridge(works: DataFrame) -> DataFrame:
    """A row for each author of a work."""
    return works.select("paper_id", F.posexplode("authors").alias("author_pos", "a")).select("paper_id", "author_pos", "a.*")


def author_ids(works: DataFrame, most: int | None = None) -> DataFrame:
    """Distinct author ids in the order in which works first name them."""
    rows = works.select("ord", F.posexplode("authors").alias("pos", "a")).select(F.struct("ord", "pos").alias("at"), tx.blank_to_null(F.col("a.author_id")).alias("author_id")).where("author_id is not null")
    out = rows.groupBy("author_id").agg(F.min("at").alias("at")).orderBy("at").select("author_id")
    return out if most is None else out.limit(max(0, most))


def enriched(works: DataFrame, metrics: DataFrame, overwrite: bool = False) -> DataFrame:
    """Authors with the h-index and affiliation of metrics (author_id, h_index). A missing metric
    keeps what the work has, unless overwrite. The affiliation comes from the first institution, for
    authors that metrics know and that have none. One shuffle by author id; metrics are broadcast only
    where Spark finds them small enough."""
    key = F.coalesce("paper_id", F.concat(F.lit("#"), F.col("ord").cast("string")))
    flat = works.select(key.alias("__k"), F.posexplode("authors").alias("pos", "a")).withColumn("__id", tx.short_id(F.col("a.author_id")))
    known = metrics.select(tx.short_id(F.col("author_id")).alias("__id"), F.col("h_index").cast("int").alias("__h"), F.lit(True).alias("__hit")).dropDuplicates(["__id"])
    met = flat.join(known, "__id", "left")
    h = F.col("__h") if overwrite else F.coalesce("__h", "a.h_index")
    if overwrite:
        author = F.col("a").withField("h_index", h)
    else:
        own = tx.blank_to_null(F.col("a.affiliation"))
        author = F.col("a").withField("h_index", h).withField("institutions", F.coalesce(institutions(F.col("a.institutions")), F.array().cast(f"array<{INSTITUTION}>")))
        author = author.withField("affiliation", F.when(F.col("__hit") & own.isNull(), affiliation_of(F.col("a.institutions"))).otherwise(F.col("a.affiliation")))
    back = met.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("pos", author.alias("a")))).alias("l"))
    back = back.select("__k", F.transform("l", lambda x: x["a"]).alias("__authors"))
    return works.withColumn("__k", key).join(back, "__k", "left").withColumn("authors", F.coalesce("__authors", "authors")).drop("__k", "__authors")


def max_h_index(authors: Column) -> Column:
    """The highest h-index there is, null if none is known."""
    return F.array_max(F.transform(authors, lambda a: a["h_index"]))


def max_h_index_author(authors: Column) -> Column:
    """The author of the highest h-index (unknown counts as 0), the first among equals."""
    rows = F.transform(authors, lambda a, i: F.struct((-F.coalesce(a["h_index"], F.lit(0))).alias("n"), i.alias("i"), F.struct(a["author_id"].alias("author_id"), a["name"].alias("name"), F.coalesce(a["h_index"], F.lit(0)).alias("h_index"), a["affiliation"].alias("affiliation"), a["institutions"].alias("institutions")).alias("a")))
    return F.try_element_at(F.array_sort(rows), F.lit(1))["a"]


def top_authors(authors: Column, k: int) -> Column:
    """The k authors of highest h-index, then by name."""
    rows = F.transform(authors, lambda a, i: F.struct((-F.coalesce(a["h_index"], F.lit(0))).alias("n"), F.coalesce(a["name"], F.lit("")).alias("name"), i.alias("i"), a.alias("a")))
    return F.transform(F.slice(F.array_sort(rows), 1, max(0, k)), lambda x: x["a"])


def self_citation(authors: Column, target_author: Column) -> Column:
    """Whether the target's author is among the authors; null without a target author."""
    target = tx.author_norm(target_author)
    return F.when(target != "", F.exists(authors, lambda a: tx.author_norm(a["name"]) == target))


# -- filters ------------------------------------------------------------------------------------


def split_ignored(works: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Works without an ignored author, and those with one, with the names that matched."""
    if not any(n.strip() for n in names):
        return works, works.where("false").withColumns({"filter_reason": F.lit(None).cast("string"), "filter_meta": F.lit(None).cast("string")})
    listed = F.transform(F.array(*[F.lit(n) for n in names if n.strip()]), tx.author_norm)
    matched = F.filter(F.transform("authors", lambda a: a["name"]), lambda n: F.array_contains(listed, tx.author_norm(n)))
    marked = works.withColumn("__m", F.coalesce(matched, F.array().cast("array<string>")))
    dropped = marked.where(F.size("__m") > 0).withColumns({"filter_reason": F.lit("ignored_author"), "filter_meta": F.to_json(F.struct(F.col("__m").alias("matched_authors")))})
    return marked.where(F.size("__m") == 0).drop("__m"), dropped.drop("__m")


def split_by_h_index(works: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    h = F.coalesce(max_h_index_author(F.col("authors"))["h_index"], F.lit(0))
    marked = works.withColumn("__h", h)
    dropped = marked.where(F.col("__h") < least).withColumns({"filter_reason": F.lit("max_h_index_below_threshold"), "filter_meta": F.to_json(F.struct(F.col("__h").alias("max_h_index"), F.lit(least).alias("threshold")))})
    return marked.where(F.col("__h") >= least).drop("__h"), dropped.drop("__h")


def is_recent_only(sources: Column) -> Column:
    return F.array_contains(sources, "recent_year") & ~F.array_contains(sources, "top_cited")


def rank_order(h: str = "max_h_index", title: str = "paper_title") -> list[Column]:
    """By highest h-index, citations and year, each falling; then title. Unknown counts as 0 or ''."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).desc()
    return [zero(h), zero("cited_by_count"), zero("year"), F.coalesce(F.col(title), F.lit("")).asc()]


def phase_one_order() -> list[Column]:
    """As rank_order, but works without a known h-index come last."""
    return [F.col("max_h_index").desc_nulls_last(), *rank_order()[1:]]


def split_recent_only(works: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame]:
    """At most `most` of the works that only the recent recall found, by rank; all others pass. None
    and numbers below 1 switch it off. The order stays that of `ord`."""
    if most is None or most <= 0:
        return works, works.where("false")
    h = F.coalesce(max_h_index_author(F.col("authors"))["h_index"], F.lit(0))
    marked = works.withColumns({"max_h_index": h, "__r": is_recent_only(F.col("recall_sources"))})
    # only the capped class is ranked, and in many tasks
    ranked = numbered(marked.where("__r").orderBy(*rank_order(), "ord"), "__n").withColumn("__n", (F.col("__n") + 1).cast("int"))
    kept = marked.where(~F.col("__r")).unionByName(ranked.where(F.col("__n") <= most).drop("__n"))
    dropped = ranked.where(F.col("__n") > most).withColumns({"filter_reason": F.lit("recent_year_cap"), "filter_meta": F.to_json(F.struct(F.lit(most).alias("cap"), F.col("__n").alias("rank")))})
    return kept.drop("__r", "max_h_index"), dropped.drop("__r", "__n", "max_h_index")


def h_index_either(works: DataFrame, least: int, least_first: int) -> DataFrame:
    """Works whose highest h-index or whose first author's is high enough. The first author is the one
    marked so, else the first in the list; works without authors go."""
    first = F.coalesce(F.try_element_at(F.filter("authors", lambda a: a["author_position"] == "first"), F.lit(1)), F.try_element_at(F.col("authors"), F.lit(1)))
    return works.where((F.size("authors") > 0) & ((F.coalesce(max_h_index(F.col("authors")), F.lit(0)) >= least) | (F.coalesce(first["h_index"], F.lit(0)) >= least_first)))


def author_works(works: DataFrame, author_id: str, k: int = 20, only_first: bool = False, over_fetch: bool = False) -> DataFrame:
    """An author's most cited works. over_fetch looks at the first min(200, max(5k, 50)) only."""
    mine = works.where(F.exists("authors", lambda a: a["author_id"] == author_id))
    order = [F.desc("cited_by_count"), F.desc("year"), F.asc("paper_id")]
    if only_first:
        if over_fetch:
            mine = mine.orderBy(*order).limit(min(200, max(5 * k, 50)))
        mine = mine.where(F.exists("authors", lambda a: (a["author_id"] == author_id) & (a["author_position"] == "first")))
    return mine.orderBy(*order).limit(max(0, k))


# -- selection ----------------------------------------------------------------------------------


def selected(works: DataFrame, k: int) -> DataFrame:
    """If any work has a fellow, those that have, all of them, in input order; else the k best."""
    with_max = works.withColumn("max_h_index", F.coalesce(F.col("max_h_index_author.h_index"), max_h_index_author(F.col("authors"))["h_index"]))
    primary = with_max.where(F.coalesce("has_fellow_topk", F.lit(False))).withColumn("selection_reason", F.lit("primary"))
    # one row says whether there is a primary work; it is joined, so nothing is collected
    any_primary = works.agg(F.coalesce(F.bool_or("has_fellow_topk"), F.lit(False)).alias("__any"))
    fallback = with_max.orderBy(*rank_order(), "ord").limit(max(0, k)).withColumn("selection_reason", F.lit("fallback"))
    fallback = fallback.join(F.broadcast(any_primary), ~F.col("__any")).drop("__any")
    return primary.unionByName(fallback).drop("max_h_index")


def influential(works: DataFrame, citations: DataFrame, metrics: DataFrame, target: str, top: int, last_years: int, as_of_year: int, least_h: int, k: int) -> DataFrame:
    """The smallest whole question: the k most influential works that cite a target."""
    found = cut(citing(works, citations, target))
    recent = in_years(found, cutoff_year(as_of_year, last_years), as_of_year)
    merged = cut(merged_recalls(("top_cited", most_cited(found, top)), ("recent_year", recent)))
    kept, _ = split_by_h_index(cut(enriched(merged, metrics)), least_h)
    return selected(kept.withColumns({"max_h_index_author": max_h_index_author(F.col("authors")), "has_fellow_topk": F.lit(False)}), k)
