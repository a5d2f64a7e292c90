"""Score statistics, reports and the flat tables of the cross-run export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def score_stats(scores: Column) -> list[Column]:
    return [F.avg(scores).alias("mean_score"), F.median(scores).alias("median_score")]


def buckets(score: Column) -> list[Column]:
    return [F.count_if(tx.score_bucket(score) == b).alias(b) for b in ("neg", "neutral", "pos")]


def paper_summaries(papers: DataFrame, contexts: DataFrame) -> DataFrame:
    """One row per paper, those without contexts too."""
    s = F.col("remark_score")
    stats = contexts.groupBy("paper_id").agg(F.count("*").alias("contexts_total"), F.count(s).alias("scored"), F.count_if(tx.blank_to_null(F.col("remark_error")).isNotNull()).alias("errors"), *score_stats(s), *buckets(s))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("contexts_total", "scored", "errors", "neg", "neutral", "pos")}
    return papers.join(stats, "paper_id", "left").withColumns(zero)


def overall_weighted(summaries: DataFrame) -> DataFrame:
    """Totals of paper summaries, with the mean weighted by scored contexts; the median is unknown."""
    total = [F.sum(c).alias(c) for c in ("contexts_total", "scored", "errors", "neg", "neutral", "pos")]
    mean = F.try_divide(F.sum(F.col("mean_score") * F.col("scored")), F.sum("scored"))
    return summaries.agg(F.count("*").alias("papers"), *total, mean.alias("mean_score"), F.lit(None).cast("double").alias("median_score"))


def overall_exact(papers: DataFrame, contexts: DataFrame) -> DataFrame:
    """Totals and statistics over all scored contexts: one row."""
    s = F.col("remark_score")
    n = papers.agg(F.count("*").alias("papers"))
    return n.crossJoin(contexts.agg(F.count("*").alias("contexts_total"), F.count(s).alias("scored"), F.count_if(tx.blank_to_null(F.col("remark_error")).isNotNull()).alias("errors"), *buckets(s), *score_stats(s)))


def top_contexts(contexts: DataFrame, n: int = 3) -> DataFrame:
    """The n best and n worst scored contexts of each paper. Equal scores: the earlier first among the
    best, the later first among the worst."""
    rows = contexts.where(F.col("remark_score").isNotNull())
    by = Window.partitionBy("paper_id")
    best = rows.withColumn("rank", F.row_number().over(by.orderBy(F.desc("remark_score"), F.asc("ctx_pos")))).where(F.col("rank") <= n).withColumn("side", F.lit("positive"))
    worst = rows.withColumn("rank", F.row_number().over(by.orderBy(F.asc("remark_score"), F.desc("ctx_pos")))).where(F.col("rank") <= n).withColumn("side", F.lit("negative"))
    return best.unionByName(worst).select("paper_id", "side", "rank", "ctx_pos", "remark_score", "reason", tx.snippet(F.col("context")).alias("snippet"), "match_text")


def _number(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.2f", c)).otherwise("n/a")


def paper_reports(papers: DataFrame, contexts: DataFrame, n: int = 3) -> DataFrame:
    """(paper_id, report): a Markdown report of each paper (paper_title, venue, self_citation)."""
    top = top_contexts(contexts, n).groupBy("paper_id", "side").agg(F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("- ["), F.col("remark_score"), F.lit("] "), F.coalesce("reason", F.lit("")), F.lit("\n  > "), F.col("snippet")).alias("s")))).alias("l"))
    lists = top.groupBy("paper_id").pivot("side", ["positive", "negative"]).agg(F.first(F.array_join(F.transform("l", lambda x: x["s"]), "\n")))
    rows = paper_summaries(papers, contexts).join(lists, "paper_id", "left")
    line = lambda name, c: F.concat(F.lit(f"- {name}: "), F.coalesce(c.cast("string"), F.lit("unknown")))
    parts = [
        F.concat(F.lit("# "), F.coalesce("paper_title", F.lit("Untitled"))),
        line("Venue", F.col("venue")), line("Self-citation", tx.self_citation_text(F.col("self_citation"))),
        line("Contexts", F.col("contexts_total")), line("Scored", F.col("scored")), line("Errors", F.col("errors")),
        line("Mean", _number(F.col("mean_score"))), line("Median", _number(F.col("median_score"))),
        F.concat(F.lit("- Negative / neutral / positive: "), F.concat_ws(" / ", "neg", "neutral", "pos")),
        F.lit("\n## Most positive"), F.coalesce("positive", F.lit("none")), F.lit("\n## Most negative"), F.coalesce("negative", F.lit("none")),
    ]
    return rows.select("paper_id", F.concat_ws("\n", *parts).alias("report"))


def fellow_first(papers: DataFrame) -> DataFrame:
    """Papers with a fellow first, input order otherwise."""
    return papers.orderBy(F.coalesce("has_fellow_topk", F.lit(False)).desc(), "ord")


def summary_report(papers: DataFrame, contexts: DataFrame) -> DataFrame:
    """One Markdown document: totals, then papers, fellow papers first."""
    o = overall_exact(papers, contexts)
    head = o.select(F.concat_ws("\n", F.lit("# Summary"), *[F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in ("papers", "contexts_total", "scored", "errors", "neg", "neutral", "pos")], F.concat(F.lit("- mean: "), _number(F.col("mean_score"))), F.concat(F.lit("- median: "), _number(F.col("median_score")))).alias("head"))
    fellow = F.coalesce("has_fellow_topk", F.lit(False))
    text = F.concat(F.when(fellow, "- [fellow] ").otherwise("- "), F.coalesce("paper_title", F.lit("Untitled")), F.lit(" ("), F.coalesce("venue", F.lit("unknown")), F.lit("): mean "), _number(F.col("mean_score")), F.lit(", "), F.col("scored").cast("string"), F.lit(" scored"))
    lines = paper_summaries(papers, contexts).agg(F.array_sort(F.collect_list(F.struct((~fellow).alias("k"), "ord", text.alias("t")))).alias("l"))
    return head.crossJoin(lines).select(F.concat_ws("\n", "head", F.lit("\n## Papers"), F.array_join(F.transform("l", lambda x: x["t"]), "\n")).alias("report"))


def summary_json(papers: DataFrame, contexts: DataFrame, target: dict[str, str | None], generated_at: str) -> DataFrame:
    """The run's summary document as one JSON string."""
    own = contexts.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ctx_pos", F.struct("context", "context_window_size", "remark_score", "reason").alias("c")))), lambda x: x["c"]).alias("contexts"))
    rows = papers.join(own, "paper_id", "left").withColumn("contexts", F.coalesce("contexts", F.array()))
    remark = F.struct(*[c for c in ("paper_title", "venue", "has_fellow_topk", "reference_entry", "self_citation", "topk_authors", "contexts") if c in rows.columns])
    body = rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", remark.alias("r")))), lambda x: x["r"]).alias("cited_paper_remarks"))
    about = F.struct(*[F.lit(target.get(k)).cast("string").alias(k) for k in ("query_title", "matched_title", "paper_id", "target_author")])
    return body.select(F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), about.alias("paper_to_analyze"), "cited_paper_remarks"), {"ignoreNullFields": "false"}).alias("summary"))


# -- export -------------------------------------------------------------------------------------


def authors_text(authors: Column) -> Column:
    """Name(h_index=…, [affiliation=…,] ieee=…, acm=…, aaai=…) of each author, joined by '; '."""

    def one(a: Column) -> Column:
        f = a["fellow_status"]
        inner = F.concat_ws(", ", F.concat(F.lit("h_index="), F.coalesce(a["h_index"].cast("string"), F.lit(""))), F.when(tx.blank_to_null(a["affiliation"]).isNotNull(), F.concat(F.lit("affiliation="), a["affiliation"])), *[F.concat(F.lit(f"{k}="), F.when(f.isNull(), "Unknown").otherwise(F.coalesce(f[k], F.lit("")))) for k in ("ieee", "acm", "aaai")])
        return F.concat(F.coalesce(a["name"], F.lit("")), F.lit("("), inner, F.lit(")"))

    return F.array_join(F.transform(authors, one), "; ")


def paper_text(title: Column, venue: Column, fellow: Column, authors: Column) -> Column:
    return F.concat_ws(" [SEP] ", F.coalesce(title, F.lit("")), F.concat(F.lit("venue="), F.coalesce(venue, F.lit(""))), F.concat(F.lit("fellow="), F.initcap(F.coalesce(fellow, F.lit(False)).cast("string"))), F.concat(F.lit("topk_authors=["), F.coalesce(authors_text(authors), F.lit("")), F.lit("]")))


def target_sheet(summaries: DataFrame) -> DataFrame:
    """A row per run: counts, and the citing papers as text, in input order."""
    r = F.coalesce("cited_paper_remarks", F.array().cast(summaries.schema["cited_paper_remarks"].dataType))
    n = lambda x: F.coalesce(F.size(x["contexts"]), F.lit(0))
    fellow = lambda x: F.coalesce(x["has_fellow_topk"], F.lit(False))
    text = lambda xs: F.array_join(F.transform(xs, lambda x: paper_text(x["paper_title"], x["venue"], x["has_fellow_topk"], x["topk_authors"])), "\n")
    return summaries.select(
        "run_id", F.col("paper_to_analyze.query_title").alias("query_title"), F.col("paper_to_analyze.matched_title").alias("matched_title"), F.col("paper_to_analyze.target_author").alias("target_author"),
        F.size(r).alias("citing_papers"), F.aggregate(r, F.lit(0), lambda a, x: a + n(x)).alias("contexts"), F.size(F.filter(r, lambda x: n(x) > 0)).alias("with_contexts"), F.size(F.filter(r, lambda x: n(x) == 0)).alias("without_contexts"),
        F.exists(r, fellow).alias("any_fellow"), text(r).alias("citing_agg"), text(F.filter(r, fellow)).alias("citing_agg_fellow"),
    )


def context_sheet(summaries: DataFrame) -> DataFrame:
    """A row per context; a paper without contexts has one row, of index 0 and text 'None'."""
    papers = summaries.select("run_id", F.col("paper_to_analyze.query_title").alias("query_title"), F.posexplode("cited_paper_remarks").alias("paper_index", "p"))
    rows = papers.select("run_id", "query_title", "paper_index", "p", F.posexplode_outer("p.contexts").alias("pos", "c"))
    return rows.select(
        "run_id", "query_title", "paper_index", F.col("p.paper_title").alias("paper_title"), F.col("p.venue").alias("venue"), F.coalesce("p.has_fellow_topk", F.lit(False)).alias("fellow"), F.col("p.self_citation").alias("self_citation"), authors_text(F.col("p.topk_authors")).alias("topk_authors"), F.col("p.reference_entry").alias("reference_entry"),
        F.coalesce("pos", F.lit(0)).alias("context_index"), F.coalesce("c.context", F.lit("None")).alias("context"), F.col("c.remark_score").alias("remark_score"), F.col("c.reason").alias("reason"), F.when(F.col("pos").isNull(), "no_context").otherwise("context").alias("row_type"),
    )
