"""Honor verification: candidate pages, rule and model evidence, and how evidence merges."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import readable, web

ORGS = ("ieee", "acm", "aaai")
#: What counts as a mention, and what as a denial.
POSITIVE = {
    "ieee": (r"(?iU)\bacm\s*/\s*ieee\s*fellow(?:s)?\b", r"(?iU)\bhe\s+was\s+acm\s+fellow\s+and\s+ieee\s+fellow\b", r"(?iU)\bieee\s+fellow\b"),
    "acm": (r"(?iU)\bacm\s*/\s*ieee\s*fellow(?:s)?\b", r"(?iU)\bhe\s+was\s+acm\s+fellow\s+and\s+ieee\s+fellow\b", r"(?iU)\bacm\s+fellow\b"),
    "aaai": (r"(?iU)\baaai\s+fellow\b",),
}
NEGATIVE = {org: rf"(?iU)\bnot\s+(?:an?\s+)?{org}\s+fellow\b" for org in ORGS}
KEYWORDS = ("biography", "acm fellow", "ieee fellow", "aaai fellow", "professor", "research interests")
LEAST_PROFILE = 200


def rule_statuses(text: Column) -> Column:
    """Statuses that a page's text tells. A mention counts even within a denial."""
    flat = F.coalesce(F.regexp_replace(text, r"(?U)\s+", " "), F.lit(""))

    def one(t: Column, org: str) -> Column:
        yes = F.lit(False)
        for p in POSITIVE[org]:
            yes = yes | t.rlike(p)
        return F.when(yes, "Yes").when(t.rlike(NEGATIVE[org]), "No").otherwise("Unknown").alias(org)

    return tx.let(flat, lambda t: F.struct(*[one(t, org) for org in ORGS]))


def rule_snippets(text: Column) -> Column:
    """array<struct<matched, snippet>> of mentions, 80 characters before to 120 after."""
    flat = F.regexp_replace(text, r"(?U)\s+", " ")
    patterns = list(dict.fromkeys(p for ps in POSITIVE.values() for p in ps))

    def cut(t: Column) -> Column:
        found = [F.transform(tx.spans(t, p), lambda s: F.struct(s["hit"].alias("matched"), F.substring(t, F.greatest(F.lit(0), s["start"] - 80) + 1, s["end"] + 120 - F.greatest(F.lit(0), s["start"] - 80)).alias("snippet"))) for p in patterns]
        return F.concat(*found)

    return tx.let(flat, cut)


def merged_evidence(evidence: DataFrame) -> DataFrame:
    """(author_key, org, status, source) of rows (author_key, ord, org, status, source): Yes over No
    over Unknown, and the first source that said so."""
    rank = F.when(F.col("status") == "Yes", 0).when(F.col("status") == "No", 1).otherwise(2)
    best = evidence.groupBy("author_key", "org").agg(F.min_by(F.struct("status", "source"), F.struct(rank, "ord")).alias("b"))
    return best.select("author_key", "org", F.when(F.col("b.status").isin("Yes", "No"), F.col("b.status")).otherwise("Unknown").alias("status"), F.when(F.col("b.status").isin("Yes", "No"), F.col("b.source")).alias("source"))


def merged_status(model: Column, rule: Column) -> Column:
    """A rule's Yes stands over anything, its No only over Unknown."""
    return F.when(rule == "Yes", "Yes").when((rule == "No") & (model == "Unknown"), "No").otherwise(model)


def merged_statuses(model: Column, rule: Column) -> Column:
    return F.struct(*[merged_status(model[o], rule[o]).alias(o) for o in ORGS])


def reply_statuses(reply: Column) -> Column:
    """Statuses of a model's JSON reply, under the honor's name or its short one, as an object with a
    status or a plain text; all Unknown unless it says that the page is the scholar's profile."""

    def said(v: Column, name: str) -> Column:
        flag = F.lower(F.trim(F.try_variant_get(v, f"$.{name}", "string")))
        return F.coalesce(flag.isin("1", "true", "yes", "y", "on") | (flag.try_cast("double") != 0), F.lit(False))

    def status(v: Column, org: str) -> Column:
        paths = [f"$.fellow{name}{part}" for name in (f"['{org.upper()} Fellow']", f".{org}") for part in (".status", "")]
        return tx.status_norm(F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths]))

    def read(v: Column) -> Column:
        ok = said(v, "is_target_scholar") & said(v, "has_valid_profile_content")
        return F.struct(*[F.when(ok, status(v, o)).otherwise("Unknown").alias(o) for o in ORGS])

    return tx.let(tx.lenient_json(reply), read)


def reply_citations(reply: Column, annotations: Column) -> Column:
    """Sources of a web search reply: its annotations, else URLs in its text; no repeats."""
    given = F.filter(F.transform(annotations, lambda u: F.trim(u)), lambda u: u != "")
    return F.array_distinct(F.when(F.coalesce(F.size(given), F.lit(0)) > 0, given).otherwise(tx.urls_in(F.coalesce(reply, F.lit("")))))


def any_fellow(authors: Column) -> Column:
    return F.coalesce(F.exists(authors, lambda a: (a["fellow_status"]["ieee"] == "Yes") | (a["fellow_status"]["acm"] == "Yes") | (a["fellow_status"]["aaai"] == "Yes")), F.lit(False))


def with_fellows(works: DataFrame, statuses: DataFrame, authors: str = "topk_authors") -> DataFrame:
    """Works whose top authors have fellow_status (all Unknown where nothing is known) and their
    sources, from statuses (author_id, statuses, sources)."""
    flat = works.select("paper_id", F.posexplode(authors).alias("pos", "a")).withColumn("author_id", F.col("a.author_id"))
    unknown = F.struct(*[F.lit("Unknown").alias(o) for o in ORGS])
    known = flat.join(statuses, "author_id", "left")
    one = F.col("a").withField("fellow_status", F.coalesce("statuses", unknown)).withField("fellow_status_sources", F.coalesce("sources", F.array().cast("array<string>")))
    back = known.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", one.alias("a")))), lambda x: x["a"]).alias("__t"))
    out = works.drop(authors).join(back, "paper_id", "left").withColumnRenamed("__t", authors)
    return out.withColumn("has_fellow_topk", any_fellow(F.col(authors)))


# -- candidate pages ----------------------------------------------------------------------------


def candidate_pages(results: DataFrame, allow_wikipedia: bool, most: int) -> DataFrame:
    """Pages worth reading for each author, best first: rows (author_key, name, rank, title, url) are
    admitted, scored, deduplicated by URL and cut; where Wikipedia is allowed its best page stays."""
    url = web.without_fragment(web.unwrapped(F.col("url")))
    rows = results.withColumns({"reason": web.admission(F.col("url"), allow_wikipedia), "url": url}).where("reason = 'ok'")
    tokens = tx.name_tokens(F.col("name"))
    flag = lambda c: F.when(c, 1).otherwise(0)
    rows = rows.withColumns({
        "score": web.candidate_score(F.col("url"), F.col("title"), tokens), "is_wikipedia": web.is_wikipedia(F.col("url")),
        "personal": flag(web.is_personal(F.col("url"), F.col("title"), tokens)), "edu": flag(F.contains(web.host(F.col("url")), F.lit(".edu"))),
        "hint": flag(web.has_profile_hint(F.col("url"), F.col("title"))), "rootish": flag(web.path_depth(F.col("url")) <= 2),
    })
    order = [F.desc("score"), F.desc("personal"), F.desc("edu"), F.desc("hint"), F.asc("is_wikipedia"), F.desc("rootish"), F.asc("rank")]
    once = rows.withColumn("__n", F.row_number().over(Window.partitionBy("author_key", "url").orderBy(*order))).where("__n = 1").drop("__n")
    placed = once.withColumns({"place": F.row_number().over(Window.partitionBy("author_key").orderBy(*order)), "__w": F.row_number().over(Window.partitionBy("author_key", "is_wikipedia").orderBy(*order))})
    forced = F.lit(allow_wikipedia) & F.col("is_wikipedia") & (F.col("__w") == 1)
    return placed.where((F.col("place") <= most) | forced).withColumn("forced", F.col("place") > most).drop("__w")


def best_extraction(attempts: DataFrame) -> DataFrame:
    """Of (page_key, strategy_pos, markdown, quality) the attempt of highest quality, then length; the
    first among equals."""
    order = [F.desc("quality"), F.length("markdown").desc(), F.asc("strategy_pos")]
    return attempts.withColumn("__n", F.row_number().over(Window.partitionBy("page_key").orderBy(*order))).where("__n = 1").drop("__n")


def extraction_attempts(pages: DataFrame, limit: int = 8000, mode: str = "auto") -> DataFrame:
    """The ways of reading a page (page_key, name, affiliation, institutions, html), with quality: all
    of them, or the one that mode names. The main content by its paragraphs, as Markdown (the body
    where none is found) and as text; the body; all text; what stands around keywords."""
    body = pages.withColumns({"__b": web.body_text(F.col("html")), "__r": readable.main_markdown(F.col("html")), "__t": readable.main_text(F.col("html"))})
    plain = tx.markdown_norm(F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "<[^>]+>", " "))
    ways = F.array(F.struct(F.lit("readability_html").alias("strategy"), tx.markdown_norm(F.coalesce(tx.blank_to_null(F.col("__r")), F.col("__b")), limit).alias("markdown")), F.struct(F.lit("readability_txt").alias("strategy"), tx.markdown_norm(F.col("__t"), limit).alias("markdown")), F.struct(F.lit("bs4_body").alias("strategy"), tx.markdown_norm(F.col("__b"), limit).alias("markdown")), F.struct(F.lit("plain_text").alias("strategy"), F.left(tx.squeezed(plain), F.lit(limit)).alias("markdown")), F.struct(F.lit("keyword_window").alias("strategy"), tx.markdown_norm(web.keyword_windows(F.col("__b"), KEYWORDS), limit).alias("markdown")))
    rows = body.select("page_key", "name", "affiliation", "institutions", F.posexplode(ways if mode == "auto" else F.filter(ways, lambda w: w["strategy"] == mode)).alias("strategy_pos", "w")).select("page_key", "name", "affiliation", "institutions", "strategy_pos", "w.*")
    return rows.withColumn("quality", web.page_quality(F.col("markdown"), F.col("name"), F.col("affiliation"), F.col("institutions")))


def long_enough(markdown: Column) -> Column:
    return F.length(markdown) >= LEAST_PROFILE


def derived_homepages(pages: DataFrame) -> DataFrame:
    """Pages that a page's text points at: of its host, academic, personal or named like the author;
    they score 50 more than their page. One step of the walk."""
    rows = pages.select("author_key", "name", "url", "score", F.posexplode(F.array_distinct(tx.urls_in(F.col("markdown")))).alias("pos", "link"))
    u = web.without_fragment(F.col("link"))
    tokens = tx.name_tokens(F.col("name"))
    near = (web.host(u) == web.host(F.col("url"))) | F.contains(web.host(u), F.lit(".edu")) | web.is_personal(u, F.lit(""), tokens)
    return rows.where((web.admission(F.col("link"), False) == "ok") & (u != F.col("url")) & near).select("author_key", "name", u.alias("url"), (F.col("score") + 50).alias("score"), F.col("url").alias("found_on"), "pos")


def walk(candidates: DataFrame, pages: DataFrame, budget: int) -> DataFrame:
    """The exact order in which an author's pages are read: (author_key, step, url). Links of a page
    that was read go to the front of the queue; it holds `budget` pages, and loses the last that is not
    Wikipedia. One author's candidates are few, so an author is a group of its own."""
    links = derived_homepages(pages.select("author_key", "name", "url", F.lit(0).alias("score"), "markdown"))
    edges = links.groupBy("author_key", F.col("found_on").alias("url")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "url"))), lambda x: x["url"]).alias("links"))
    rows = candidates.select("author_key", "url", "place", "is_wikipedia").unionByName(edges.join(candidates.select("author_key", "url"), ["author_key", "url"], "left_anti").select("author_key", "url", F.lit(None).cast("int").alias("place"), F.lit(False).alias("is_wikipedia")))
    rows = rows.join(edges, ["author_key", "url"], "left")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["author_key"].iloc[0]
        known = {r.url: list(r.links) if r.links is not None else [] for r in pdf.itertuples()}
        wiki = {r.url for r in pdf.itertuples() if r.is_wikipedia}
        queue = [r.url for r in pdf[pdf["place"].notna()].sort_values("place").itertuples()][:budget]
        seen, out = set(queue), []
        while queue and len(out) < budget:
            url = queue.pop(0)
            out.append(url)
            fresh = [u for u in known.get(url, []) if u not in seen]
            seen.update(fresh)
            queue = fresh + queue
            while len(out) + len(queue) > budget:
                drop = next((i for i in range(len(queue) - 1, -1, -1) if queue[i] not in wiki), len(queue) - 1)
                queue.pop(drop)
        return pd.DataFrame({"author_key": key, "step": range(len(out)), "url": out})

    return rows.groupBy("author_key").applyInPandas(one, "author_key string, step long, url string")


# -- lookup -------------------------------------------------------------------------------------


def local_lookup(pages: DataFrame, replies: DataFrame) -> DataFrame:
    """(author_key, statuses, sources, error) from read pages and a model's replies to them. Static
    pages come first; a dynamic page counts only where its static one was too short to be judged."""
    readable = pages.where(long_enough(F.col("markdown")))
    static = readable.where("phase = 'static'")
    dynamic = readable.where("phase = 'dynamic'").join(static.select("author_key", "url"), ["author_key", "url"], "left_anti")
    met = static.unionByName(dynamic).join(replies, ["author_key", "url"], "left")
    merged = met.withColumn("m", merged_statuses(F.coalesce(reply_statuses(F.col("reply")), F.struct(*[F.lit("Unknown").alias(o) for o in ORGS])), rule_statuses(F.col("markdown"))))
    rows = merged.select("author_key", F.col("step").alias("ord"), F.explode(F.array(*[F.struct(F.lit(o).alias("org"), F.col(f"m.{o}").alias("status")) for o in ORGS])).alias("e"), F.col("url").alias("source")).select("author_key", "ord", "e.org", "e.status", "source")
    best = merged_evidence(rows).groupBy("author_key").pivot("org", list(ORGS)).agg(F.first(F.struct("status", "source")))
    keys = pages.select("author_key").distinct()
    out = keys.join(best, "author_key", "left").select("author_key", F.struct(*[F.coalesce(F.col(f"{o}.status"), F.lit("Unknown")).alias(o) for o in ORGS]).alias("statuses"), F.array_distinct(F.filter(F.array(*[F.col(f"{o}.source") for o in ORGS]), lambda s: s.isNotNull())).alias("sources"))
    return out.withColumn("error", F.when(tx.all_unknown(F.col("statuses")), "no_evidence"))


def dispatched(local: DataFrame, remote: DataFrame | None, mode: str = "local_only") -> DataFrame:
    """local_only, remote_only, or local_with_fallback: the remote result where the local one failed
    or knows nothing."""
    if mode == "local_only":
        return local
    if remote is None:
        raise ValueError("a remote result is needed")
    if mode == "remote_only":
        return remote
    if mode != "local_with_fallback":
        raise ValueError(f"mode {mode!r}")
    bad = F.col("l.error").isNotNull() | tx.all_unknown(F.col("l.statuses")) | F.col("l.statuses").isNull()
    joined = local.alias("l").join(remote.alias("r"), "author_key", "left")
    use = bad & F.col("r.statuses").isNotNull()
    return joined.select("author_key", *[F.when(use, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in ("statuses", "sources", "error")])


def finalized(results: DataFrame, debug_path: Callable[[Column], Column] | None = None) -> DataFrame:
    """Statuses normalised, sources without repeats; the error names its debug file if there is one."""
    error = F.col("error") if debug_path is None else F.when(F.col("error").isNotNull(), F.concat("error", F.lit(" (debug: "), debug_path(F.col("author_key")), F.lit(")")))
    return results.select("author_key", tx.statuses(F.col("statuses.ieee"), F.col("statuses.acm"), F.col("statuses.aaai")).alias("statuses"), F.array_distinct(F.filter(F.transform("sources", lambda u: F.trim(u)), lambda u: u != "")).alias("sources"), error.alias("error"))
