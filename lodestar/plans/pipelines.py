"""The three entries as plans: one target from end to end, contexts by h-index, cross-run export.

What a network, a browser or a model gives comes in as tables (or a scoring client); every function
takes and returns DataFrames and nothing runs before a sink or an action.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..operators import honors, references, reports, scoring, status, works
from ..sources import tables
from .params import Params


@dataclass
class Inputs:
    """works, citations (citing_id, cited_id), metrics (author_id, h_index), hits of the bibliography,
    statuses (author_id, statuses, sources), fulltext (paper_id, text). cut writes a stage as a table
    and reads it again."""

    works: DataFrame
    citations: DataFrame
    metrics: DataFrame
    hits: DataFrame
    statuses: DataFrame
    fulltext: DataFrame
    cut: Callable[[DataFrame], DataFrame] = session.cut


def matched_target(inputs: Inputs, p: Params) -> dict:
    """The target work; a title without any match is an error."""
    found = tables.by_title(inputs.works, p.title, 3)
    pairs = found.select(F.lit("q").alias("query_id"), F.lit(p.title).alias("query_title"), (F.row_number().over(works.Window.orderBy("paper_id")) - 1).alias("pos"), F.col("paper_title").alias("candidate_title"), "paper_id")
    best = status.best_title_match(pairs, p.match_threshold).first()
    if best is None or not best["paper_id"]:
        raise ValueError(f"no work matches {p.title!r}")
    return best.asDict()


def work_of_title(inputs: Inputs, title: str, candidates: int = 5, threshold: float = 0.6) -> DataFrame:
    """The whole work that a title names, with match_score and the titles that came next."""
    found = tables.by_title(inputs.works, title, candidates)
    place = F.row_number().over(works.Window.orderBy("paper_id")) - 1  # of `candidates` rows
    pairs = found.select(F.lit("q").alias("query_id"), F.lit(title).alias("query_title"), place.alias("pos"), F.col("paper_title").alias("candidate_title"), "paper_id")
    best = status.best_title_match(pairs, threshold).select("paper_id", F.col("score").alias("match_score"), "is_confident")
    others = pairs.agg(F.array_sort(F.collect_list("candidate_title")).alias("candidates"))
    return inputs.works.join(F.broadcast(best), "paper_id").crossJoin(F.broadcast(others))


def cited_by_of_title(inputs: Inputs, title: str, k: int = 20, with_h_index: bool = True, candidates: int = 5) -> DataFrame:
    """The k most cited works that cite the work a title names; authors with their h-index if wanted."""
    target = work_of_title(inputs, title, candidates).select(F.col("paper_id").alias("__target"))
    cites = inputs.citations.join(F.broadcast(target), F.col("cited_id") == F.col("__target")).select("citing_id", F.lit("t").alias("cited_id"))
    top = works.top_cited(inputs.works, cites, "t", k)
    return works.enriched(top, inputs.metrics, overwrite=True) if with_h_index else top


def recall_counters(inputs: Inputs, p: Params, target: str) -> DataFrame:
    """What the recalls found: top_cited_count, recent_year_count, merged_total, duplicates_dropped."""
    s = recalled(inputs, p, target).select(F.col("recall_sources").alias("s"))
    n = lambda name: F.count_if(F.array_contains("s", name))
    counted = s.agg(n("top_cited").alias("top_cited_count"), n("recent_year").alias("recent_year_count"), F.count("*").alias("merged_total"))
    return counted.withColumn("duplicates_dropped", F.col("top_cited_count") + F.col("recent_year_count") - F.col("merged_total"))


def stage_counters(chosen: DataFrame, dropped: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """(counter, value) of the later stages: dropped works by reason, selected works by reason, works
    with a fellow, errors of contexts."""
    count = lambda df, name: df.groupBy(name.alias("counter")).agg(F.count("*").alias("value"))
    out = count(dropped, F.concat(F.lit("dropped_"), F.col("filter_reason"))).unionByName(count(chosen, F.concat(F.lit("selected_"), F.col("selection_reason"))))
    out = out.unionByName(chosen.agg(F.count_if("has_fellow_topk").alias("value")).select(F.lit("with_fellow").alias("counter"), "value"))
    if contexts is not None:
        out = out.unionByName(contexts.agg(F.count_if(F.coalesce("ref_id", F.lit(0)) == 0).alias("value")).select(F.lit("context_missing").alias("counter"), "value"))
    return out


def recalled(inputs: Inputs, p: Params, target: str) -> DataFrame:
    found = inputs.cut(works.citing(inputs.works, inputs.citations, target))
    recalls = [("top_cited", works.most_cited(found, p.cited_by_top))]
    if p.recent_years:
        recalls.append(("recent_year", works.in_years(found, works.cutoff_year(p.as_of_year, p.recent_years), p.as_of_year)))
    return inputs.cut(works.merged_recalls(*recalls))


def candidates(inputs: Inputs, p: Params, target: str) -> tuple[DataFrame, DataFrame]:
    """The selected citing works, and those dropped on the way with their reasons."""
    rows = recalled(inputs, p, target).withColumn("query_title", F.col("paper_title"))
    rows = status.published(status.publication_status(rows, inputs.hits)).drop("query_title", "status_error")
    rows, ignored = works.split_ignored(inputs.cut(rows), list(p.ignore_authors))
    rows = inputs.cut(works.with_h_index_defaults(works.enriched(rows, inputs.metrics)))
    rows, low = works.split_by_h_index(rows, p.min_max_h_index)
    rows, capped = works.split_recent_only(rows, p.recent_cap)
    dropped = ignored.unionByName(low, allowMissingColumns=True).unionByName(capped, allowMissingColumns=True)
    rows = rows.withColumns({"max_h_index_author": works.max_h_index_author(F.col("authors")), "topk_authors": works.top_authors(F.col("authors"), p.fellow_top_authors)})
    return inputs.cut(works.selected(inputs.cut(honors.with_fellows(rows, inputs.statuses)), p.fallback_top)), dropped


def contexts_of(chosen: DataFrame, fulltext: DataFrame, p: Params, matched_title: str, cut: Callable[[DataFrame], DataFrame] = session.cut) -> DataFrame:
    """Reference contexts of chosen works by the matched title, then by the one asked for. Works
    without a text have an error."""
    texts = chosen.select("paper_id").join(fulltext, "paper_id")
    first = references.reference_contexts(texts.withColumn("title", F.lit(matched_title)), p.window, p.entry_threshold, cut=cut)
    if matched_title == p.title:
        found = first
    else:  # only papers without an entry under the matched title are parsed again
        first = cut(first)
        again = texts.join(first.where(F.coalesce("ref_id", F.lit(0)) == 0).select("paper_id"), "paper_id", "left_semi")
        second = references.reference_contexts(again.withColumn("title", F.lit(p.title)), p.window, p.entry_threshold, cut=cut)
        found = references.with_second_title(first, second)
    # read by reports, scores and summaries: kept, so that texts are parsed once
    return chosen.join(cut(found), "paper_id", "left").withColumn("fulltext_error", F.when(F.col("match_score").isNull(), "no_fulltext"))


def scored_contexts(payloads: DataFrame, p: Params, target_title: str, client: Callable[[str], str] | None = None) -> DataFrame:
    rows = payloads.select("paper_id", F.col("paper_title").alias("citing_title"), "reference_entry", F.posexplode("contexts").alias("ctx_pos", "c"))
    rows = rows.select("paper_id", "citing_title", "reference_entry", "ctx_pos", "c.match_text", "c.context", F.lit(target_title).alias("target_title"), F.lit(p.window).alias("context_window_size"), F.lit(None).cast("int").alias("remark_score"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("remark_error"))
    if p.dry_run or client is None:
        return scoring.dry_run(rows, p.max_contexts)
    return scoring.scored_by(rows, client, p.max_contexts)


@dataclass
class Outcome:
    target: dict
    dropped: DataFrame
    papers: DataFrame
    contexts: DataFrame

    def paper_reports(self) -> DataFrame:
        return reports.paper_reports(self.papers, self.contexts)

    def summary(self) -> DataFrame:
        return reports.summary_report(self.papers, self.contexts)

    def summary_json(self, p: Params, generated_at: str) -> DataFrame:
        about = {"query_title": p.title, "matched_title": self.target["candidate_title"], "paper_id": self.target["paper_id"], "target_author": p.target_author}
        return reports.summary_json(self.papers, self.contexts, about, generated_at)


def one_target(inputs: Inputs, p: Params, client: Callable[[str], str] | None = None) -> Outcome:
    """Entry A: a target title to scored remarks."""
    target = matched_target(inputs, p)
    chosen, dropped = candidates(inputs, p, target["paper_id"])
    payloads = contexts_of(inputs.cut(chosen), inputs.fulltext, p, target["candidate_title"], inputs.cut)
    contexts = scored_contexts(payloads, p, target["candidate_title"], client)
    venue = works.first_filled(F.col("publication_status.venue"), F.col("venue"))
    kept = payloads.drop("contexts", "query_title").withColumnsRenamed({"errors": "ref_ctx_errors", "error": "ref_ctx_error"})
    papers = kept.withColumns({"venue": venue, "self_citation": works.self_citation(F.col("authors"), F.lit(p.target_author).cast("string"))})
    return Outcome(target, dropped, papers, contexts)


def contexts_by_h_index(inputs: Inputs, p: Params, done: DataFrame | None = None) -> DataFrame:
    """Entry B: the citing works by highest h-index, with their contexts; those done are left out."""
    target = matched_target(inputs, p)
    rows = works.enriched(recalled(inputs, p, target["paper_id"]), inputs.metrics, overwrite=True)
    ranked = rows.withColumn("max_h_index", works.max_h_index(F.col("authors"))).orderBy(*works.phase_one_order(), "ord").limit(p.cited_by_top)
    todo = tables.without_output(ranked, done) if done is not None else ranked
    return contexts_of(inputs.cut(todo), inputs.fulltext, p, target["candidate_title"], inputs.cut)


def context_counters(payloads: DataFrame) -> DataFrame:
    return payloads.agg(F.count("*").alias("context_attempted"), F.count_if(F.coalesce("ref_id", F.lit(0)) != 0).alias("context_ref_id_found"))


def export(summaries: DataFrame) -> dict[str, DataFrame]:
    """Entry C: the flat tables of all runs."""
    return {"targets": reports.target_sheet(summaries), "contexts": reports.context_sheet(summaries)}
