import json

import pytest
from pyspark.sql import functions as F

from lodestar.operators import caches, honors, knowledge, pdf, reports, scoring, status


def contexts(spark, rows):
    return spark.createDataFrame(rows, "paper_id string, ctx_pos int, target_title string, citing_title string, reference_entry string, match_text string, context string, remark_score int, reason string, remark_error string")


def test_publication_classes(spark):
    t = spark.createDataFrame([("A Title",), ("Other",), ("Ünï Títle",), ("  ",)], "query_title string")
    h = spark.createDataFrame(
        [("A Title", 0, 5, "A title.", "CoRR", "2020", "Journal Articles", "u", None, ["https://doi.org/10.1/x"]), ("A Title", 1, 1, "a TITLE", "ICML", "x", "Conference and Workshop Papers", "v", None, ["https://doi.org/10.2/y"]), ("Other", 0, 9, "Quite unlike", "ICML", "2020", "Journal Articles", "w", None, [])],
        "query_title string, pos int, hit_score int, title string, venue string, year string, type string, url string, doi string, links array<string>",
    )
    got = {r["query_title"]: r for r in status.publication_status(t, h).collect()}
    assert got["A Title"]["publication_status"]["status"] == "published" and got["A Title"]["publication_status"]["doi"] == "10.2/y"
    assert got["Other"]["status_error"] == "no_match" and got["  "]["publication_status"]["status"] == "unknown"


def test_hits_of_any_shape(spark):
    many = json.dumps({"result": {"hits": {"hit": [{"@score": "3", "info": {"title": "T", "ee": ["a", {"text": "b"}]}}]}}})
    single = json.dumps({"result": {"hits": {"hit": {"@score": "2", "info": {"title": "U", "ee": "c"}}}}})
    df = spark.createDataFrame([("q", many), ("r", single), ("s", "{}")], "query_title string, answer string")
    assert sorted((r["query_title"], r["hit_score"], r["title"], r["links"]) for r in status.hit_rows(df).collect()) == [("q", 3, "T", ["a", "b"]), ("r", 2, "U", ["c"])]


def test_title_match_first_wins(spark):
    df = spark.createDataFrame([("q", "Graph Nets", 0, "graph net", "a"), ("q", "Graph Nets", 1, "Graph nets!", "b"), ("q", "Graph Nets", 2, "graph NETS", "c"), ("z", "zzz", 0, "abc", "d")], "query_id string, query_title string, pos int, candidate_title string, paper_id string")
    assert [(r["query_id"], r["paper_id"], r["score"]) for r in status.best_title_match(df).collect()] == [("q", "b", 1.0)]


@pytest.mark.parametrize(("reply", "want"), [('{"remark_score": 7, "reason": "ok"}', (7, None)), ('hm {"remark_score": "2.5", "reason": "r"} x', (2, None)), ('{"remark_score": true, "reason": "r"}', (None, "invalid_score")), ('{"remark_score": 11, "reason": "r"}', (10, None)), ('{"remark_score": 3, "reason": " "}', (None, "empty_reason")), ("{bad", (None, "no_json"))])
def test_replies(spark, reply, want):
    r = spark.createDataFrame([(reply,)], "r string").select(scoring.parsed_reply(F.col("r")).alias("x")).first()["x"]
    assert (r["remark_score"], r["error"]) == want


def test_client_scores_and_failures(spark):
    rows = contexts(spark, [("p", i, "T", "C", None, "[1]", f"c{i % 2}", 9 if i == 0 else None, "had" if i == 0 else None, None) for i in range(4)])

    def client(prompt):
        if '"c1"' in prompt:
            raise RuntimeError("down")
        return 'sure {"remark_score": 8, "reason": "good"}'

    got = {r["ctx_pos"]: (r["remark_score"], r["reason"], r["remark_error"]) for r in scoring.scored_by(rows, client, most=3).collect()}
    assert got == {0: (9, "had", None), 1: (5, None, "down"), 2: (8, "good", None), 3: (None, None, None)}


def test_top_contexts_tiebreaks(spark):
    rows = contexts(spark, [("p", i, "", "", "", "", "c", s, "", None) for i, s in enumerate([5, 5, 5, None])])
    got = sorted((r["side"], r["rank"], r["ctx_pos"]) for r in reports.top_contexts(rows, 2).collect())
    assert got == [("negative", 1, 2), ("negative", 2, 1), ("positive", 1, 0), ("positive", 2, 1)]


def test_reports_keep_papers_without_contexts(spark):
    papers = spark.createDataFrame([("p", "Title", "V", True, None, 0), ("q", "Empty", None, None, True, 1)], "paper_id string, paper_title string, venue string, self_citation boolean, has_fellow_topk boolean, ord int")
    rows = contexts(spark, [("p", 0, "", "", "", "[1]", "good", 8, "r", None), ("p", 1, "", "", "", "[1]", "bad", None, None, "e")])
    s = {r["paper_id"]: r for r in reports.paper_summaries(papers, rows).collect()}
    assert (s["p"]["contexts_total"], s["p"]["scored"], s["p"]["errors"], s["p"]["pos"]) == (2, 1, 1, 1) and s["q"]["contexts_total"] == 0 and s["q"]["mean_score"] is None
    text = {r["paper_id"]: r["report"] for r in reports.paper_reports(papers, rows).collect()}
    assert "Self-citation: true" in text["p"] and "Contexts: 0" in text["q"]
    whole = reports.summary_report(papers, rows).first()["report"]
    assert whole.index("Empty") < whole.index("Title (V)")
    doc = json.loads(reports.summary_json(papers.withColumn("reference_entry", F.lit("e")), rows.withColumn("context_window_size", F.lit(5)), {"query_title": "q"}, "now").first()[0])
    assert [len(r["contexts"]) for r in doc["cited_paper_remarks"]] == [2, 0]


def test_rules_and_lattice(spark):
    said = spark.createDataFrame([("an ACM/IEEE Fellow",), ("not an ACM fellow",), ("AAAI\nFellow",), (None,)], "t string").select(honors.rule_statuses(F.col("t")).alias("s")).collect()
    assert [tuple(r["s"]) for r in said] == [("Yes", "Yes", "Unknown"), ("Unknown", "Yes", "Unknown"), ("Unknown", "Unknown", "Yes"), ("Unknown",) * 3]
    e = spark.createDataFrame([("a", 0, "acm", "No", "u0"), ("a", 1, "acm", "Yes", "u1"), ("a", 2, "acm", "Yes", "u2"), ("a", 0, "ieee", "No", "u3"), ("a", 1, "ieee", "Unknown", "u4"), ("a", 1, "aaai", "Unknown", "u5")], "author_key string, ord int, org string, status string, source string")
    assert sorted((r["org"], r["status"], r["source"]) for r in honors.merged_evidence(e).collect()) == [("aaai", "Unknown", None), ("acm", "Yes", "u1"), ("ieee", "No", "u3")]


def test_lookup_modes(spark):
    page = "Ann Lee is an IEEE Fellow. " * 12
    pages = spark.createDataFrame([("a", 0, "u", "static", page), ("a", 1, "u", "dynamic", page), ("b", 0, "v", "static", "short"), ("b", 1, "v", "dynamic", "nothing of note. " * 20)], "author_key string, step int, url string, phase string, markdown string")
    replies = spark.createDataFrame([("a", "u", '{"is_target_scholar": true, "has_valid_profile_content": "yes", "fellow": {"ACM Fellow": {"status": "yes", "year": 2001}, "ieee": "No"}}'), ("b", "v", '{"is_target_scholar": false, "has_valid_profile_content": true, "fellow": {"acm": "yes"}}')], "author_key string, url string, reply string")
    local = honors.local_lookup(pages, replies)
    got = {r["author_key"]: r for r in local.collect()}
    assert tuple(got["a"]["statuses"]) == ("Yes", "Yes", "Unknown") and got["a"]["sources"] == ["u"] and got["a"]["error"] is None
    assert got["b"]["error"] == "no_evidence"
    remote = spark.createDataFrame([("b", ("No", "Yes", "Unknown"), ["w"], None)], "author_key string, statuses struct<ieee:string,acm:string,aaai:string>, sources array<string>, error string")
    both = {r["author_key"]: r["statuses"]["acm"] for r in honors.dispatched(local, remote, "local_with_fallback").collect()}
    assert both == {"a": "Yes", "b": "Yes"}
    with pytest.raises(ValueError):
        honors.dispatched(local, remote, "odd")


def test_candidate_pages_force_wikipedia(spark):
    rows = [("a", "Ann Lee", 0, "Ann Lee", "https://en.wikipedia.org/wiki/Ann_Lee"), ("a", "Ann Lee", 1, "Prof. Ann Lee", "https://cs.x.edu/~lee#top"), ("a", "Ann Lee", 2, "dup", "https://cs.x.edu/~lee"), ("a", "Ann Lee", 3, "acm", "https://dl.acm.org/p"), ("a", "Ann Lee", 4, "News", "https://news.com/x")]
    df = spark.createDataFrame(rows, "author_key string, name string, rank int, title string, url string")
    got = sorted((r["place"], r["url"], r["forced"]) for r in honors.candidate_pages(df, True, 1).collect())
    assert got == [(1, "https://cs.x.edu/~lee", False), (3, "https://en.wikipedia.org/wiki/Ann_Lee", True)]


def test_page_walk_follows_links_first(spark):
    c = spark.createDataFrame([("a", "https://x.edu/1", 1, False), ("a", "https://y.org/2", 2, False)], "author_key string, url string, place int, is_wikipedia boolean")
    p = spark.createDataFrame([("a", "Ann", "https://x.edu/1", "see https://x.edu/home and https://acm.org/z")], "author_key string, name string, url string, markdown string")
    assert [r["url"] for r in honors.walk(c, p, 3).orderBy("step").collect()] == ["https://x.edu/1", "https://x.edu/home", "https://y.org/2"]


def test_pdf_resolution(spark):
    r = spark.createDataFrame([("deep graph parsing", 0, "home", "https://a.org/p"), ("deep graph parsing", 1, "Deep graph parsing", "https://arxiv.org/abs/1"), ("deep graph parsing", 2, "x", "https://b.org/none")], "query string, rank int, title string, url string")
    p = spark.createDataFrame([("https://a.org/p", '<a href="x/other.pdf">a</a><a href="deep-graph-parsing.pdf">b</a>'), ("https://b.org/none", "<p>nothing</p>")], "url string, html string")
    got = {x["rank"]: x["pdf_url"] for x in pdf.resolved(r, p).collect()}
    assert got == {0: "https://a.org/x/other.pdf", 1: "https://arxiv.org/pdf/1.pdf", 2: None}
    ok = spark.createDataFrame([("https://arxiv.org/pdf/1.pdf", True), ("https://a.org/deep-graph-parsing.pdf", False)], "pdf_url string, ok boolean")
    assert pdf.first_usable(pdf.resolved(r, p), ok).first()["rank"] == 1


def test_pdf_resolution_broadcasts_nothing(spark):
    """Pages and results grow with the corpus, however small Spark takes them for."""
    k = F.col("id").cast("string")
    r = spark.range(9).select(F.concat(F.lit("deep graph parsing "), k).alias("query"), F.col("id").cast("int").alias("rank"), F.lit("x").alias("title"), F.concat(F.lit("https://a.org/p"), k).alias("url"))
    p = spark.range(9).select(F.concat(F.lit("https://a.org/p"), k).alias("url"), F.concat(F.lit('<a href="deep-graph-parsing.pdf?'), k, F.lit('">b</a>')).alias("html"))
    found = pdf.resolved(r, p)
    usable = pdf.first_usable(found, spark.range(9).select(F.concat(F.lit("https://a.org/deep-graph-parsing.pdf?"), k).alias("pdf_url"), F.lit(True).alias("ok")))
    for df in (found, usable):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert {x["pdf_url"] for x in found.collect()} == {f"https://a.org/deep-graph-parsing.pdf?{i}" for i in range(9)}


def test_graph_people(spark):
    e = spark.createDataFrame([("Q1", {"P31": ["Q5"], "P108": ["O1"], "P166": ["W1", "W2"]}), ("Q2", {"P31": ["Q5"]}), ("Q3", {"P31": ["Q9"]})], "qid string, claims map<string,array<string>>")
    n = spark.createDataFrame([("O1", {"en": "MIT"}, {"en": ["Massachusetts Institute"]}), ("W1", {"en": "ACM Fellow"}, {}), ("W2", {"de": "Preis"}, {})], "qid string, labels map<string,string>, aliases map<string,array<string>>")
    h = spark.createDataFrame([("a", "MIT CSAIL", 0, "Q3"), ("a", "MIT CSAIL", 1, "Q2"), ("a", "MIT CSAIL", 2, "Q1"), ("b", "Other", 0, "Q3"), ("b", "Other", 1, "Q2")], "author_key string, affiliation string, rank int, qid string")
    people = knowledge.author_entities(h, e, n)
    assert sorted(map(tuple, people.collect())) == [("a", "Q1", "affiliation"), ("b", "Q2", "human")]
    assert [tuple(r) for r in knowledge.award_totals(knowledge.awards(people, e, n)).collect()] == [("a", 2, 1)]


def test_caches(spark):
    c = spark.createDataFrame([("k1", "100.0", 2), ("k2", "x", 2), ("k3", "100.0", 1), ("k4", "-99999999", 2)], "key string, timestamp string, version int")
    assert [r["key"] for r in caches.valid(c, 200.0).collect()] == ["k1"]
    hits, misses = caches.with_hits(spark.createDataFrame([("k1",), ("z",)], "key string"), c)
    assert (hits.count(), [r["key"] for r in misses.collect()]) == (1, ["z"])
    old = spark.createDataFrame([("k", "1", "a", None)], "key string, at string, x string, y string")
    new = spark.createDataFrame([("k", "2", None, "b")], "key string, at string, x string, y string")
    assert tuple(caches.merged_fields(old, new, "key", "at").select("at", "x", "y").first()) == ("2", "a", "b")
    assert caches.latest(old.unionByName(new), "key", "at").first()["y"] == "b"
