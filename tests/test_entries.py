import json
import tempfile
import uuid
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lodestar.operators import sinks
from lodestar.plans import params, pipelines
from lodestar.plans.params import Params
from lodestar.sources import fulltext, rest, tables
from lodestar.streaming import trace
from tests.test_works import author, works


def inputs(spark):
    folder = tempfile.mkdtemp()

    def cut(df):
        at = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    text = "Alpha (Bo, 2020) and Bo (2020).\n\nReferences\n\nBo, A. The Target Title. 2020.\n\nCy, B. Something else here. 2019.\n"
    w = works(spark, [("T", "The Target Title", 2018, 5, 0, []), ("P1", "Citing One", 2024, 10, 1, [author("a", name="Ann"), author("b", name="Bob")]), ("P2", "Citing Two", 2023, 90, 2, [author("c", name="Cid")]), ("P3", "Citing Three", 2010, 50, 3, [author("d", name="Ban")])]).withColumn("venue", F.lit("V"))
    hits = spark.createDataFrame([(t, 0, 1, t, "ICML", "2020", "Journal Articles", "u", None, ["x"]) for t in ("Citing One", "Citing Two", "Citing Three")], "query_title string, pos int, hit_score int, title string, venue string, year string, type string, url string, doi string, links array<string>")
    return pipelines.Inputs(
        w, spark.createDataFrame([(p, "T") for p in ("P1", "P2", "P3")], "citing_id string, cited_id string"), spark.createDataFrame([("a", 40), ("c", 60), ("d", 99)], "author_id string, h_index int"), hits,
        spark.createDataFrame([("a", ("Yes", "Unknown", "Unknown"), ["s"])], "author_id string, statuses struct<ieee:string,acm:string,aaai:string>, sources array<string>"),
        spark.createDataFrame([("P1", text), ("P2", text)], "paper_id string, text string"),
        cut,
    )


def test_one_target_end_to_end(spark):
    p = Params("the target title", target_author="Ann", ignore_authors=("BAN",), as_of_year=2024, recent_years=2)
    out = pipelines.one_target(inputs(spark), p)
    papers = {r["paper_id"]: r for r in out.papers.collect()}
    assert list(papers) == ["P1"] and papers["P1"]["selection_reason"] == "primary" and papers["P1"]["self_citation"] is True
    assert [r["paper_id"] for r in out.dropped.collect()] == ["P3"]
    scores = out.contexts.collect()
    assert len(scores) == 2 and all(0 <= r["remark_score"] <= 10 for r in scores)
    doc = json.loads(out.summary_json(p, "now").first()[0])
    assert doc["paper_to_analyze"]["matched_title"] == "The Target Title" and len(doc["cited_paper_remarks"][0]["contexts"]) == 2
    with pytest.raises(ValueError):
        pipelines.matched_target(inputs(spark), Params("zzzz qqqq"))


def test_contexts_by_h_index_skips_done(spark):
    done = spark.createDataFrame([("P1",)], "paper_id string")
    got = pipelines.contexts_by_h_index(inputs(spark), Params("The Target Title"), done)
    assert sorted((r["paper_id"], r["fulltext_error"]) for r in got.collect()) == [("P2", None), ("P3", "no_fulltext")]
    assert tuple(pipelines.context_counters(got).first()) == (2, 1)


def test_export(spark, tmp_path):
    body = {"generated_at": "x", "paper_to_analyze": {"query_title": "Q", "matched_title": "M", "paper_id": "T", "target_author": None}, "cited_paper_remarks": [{"paper_title": "A", "venue": "V", "has_fellow_topk": True, "reference_entry": "r", "self_citation": None, "topk_authors": [{"name": "Ann", "h_index": 4, "affiliation": "", "fellow_status": {"ieee": "Yes", "acm": None, "aaai": "No"}}], "contexts": []}, {"paper_title": "B", "venue": None, "has_fellow_topk": None, "contexts": [{"context": "c", "remark_score": 3}]}]}
    for run, text in (("r1", json.dumps(body)), ("r2", "{broken")):
        (tmp_path / run / "res").mkdir(parents=True)
        (tmp_path / run / "res" / "summary.json").write_text(text)
    sheets = pipelines.export(tables.summaries(spark, str(tmp_path)))
    t = sheets["targets"].collect()
    assert len(t) == 1 and (t[0]["citing_papers"], t[0]["contexts"], t[0]["with_contexts"], t[0]["any_fellow"]) == (2, 1, 1, True)
    assert t[0]["citing_agg_fellow"] == "A [SEP] venue=V [SEP] fellow=True [SEP] topk_authors=[Ann(h_index=4, ieee=Yes, acm=, aaai=No)]"
    rows = sheets["contexts"].orderBy("paper_index").collect()
    assert [(r["row_type"], r["context"], r["context_index"]) for r in rows] == [("no_context", "None", 0), ("context", "c", 0)]
    sinks.write_sheets(sheets, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/contexts")).count() == 2


def test_params_and_context(tmp_path):
    for bad in ({"cited_by_top": 0}, {"recent_cap": -1}, {"recent_years": 0}, {"match_threshold": 2.0}):
        with pytest.raises(ValueError):
            Params("t", **bad)
    assert params.preset("script", "t").min_max_h_index == 30
    assert params.redacted({"LODESTAR_API_KEY": "s", "LODESTAR_X": "1", "OTHER": "2"}, ("LODESTAR_",)) == {"LODESTAR_API_KEY": "***", "LODESTAR_X": "1"}
    assert params.run_id(datetime(2024, 1, 2, tzinfo=UTC)).startswith("20240102_000000_")
    ctx = params.RunContext.create(Params("t"), str(tmp_path))
    assert (tmp_path / ctx.run_id / "res").is_dir()


def test_rest_paging_and_retries():
    waits, answers = [], iter([rest.HttpError(429, "3"), rest.HttpError(503), '{"ok": 1}'])

    def get(url):
        if isinstance(x := next(answers), Exception):
            raise x
        return x

    assert rest.get_json("u", get=get, sleep=waits.append) == {"ok": 1} and waits == [3.0, 2.0]
    with pytest.raises(rest.HttpError):
        rest.get_json("u", get=lambda u: (_ for _ in ()).throw(rest.HttpError(404)), sleep=waits.append)
    pages = iter([{"results": [1], "meta": {"next_cursor": "b"}}, {"results": [2], "meta": {"next_cursor": None}}])
    assert list(rest.pages("u", {}, get=lambda u: next(pages))) == [[1], [2]]
    assert rest.loose_int("7 ", 1) == 7 and rest.loose_int(True, 1) == 1 and rest.loose_bool("Yes") and not rest.loose_bool("maybe")
    assert rest.llm_settings({"llm": {"model": "m"}}, env={"LODESTAR_LLM_MAX_TOKENS": "9"})["max_tokens"] == 9


def test_fulltext_backends(spark):
    fulltext.register("fake", lambda content, most, stem: (([content.decode()] * 3)[:most], 3))
    df = spark.createDataFrame([("a", b"page"), ("b", b"\xff")], "path string, content binary")
    got = {r["path"]: r for r in fulltext.fulltexts(df, "fake", 2).collect()}
    assert got["a"]["text"] == "page\n\npage" and got["a"]["truncated"] and got["b"]["error"].startswith("UnicodeDecodeError")
    assert fulltext.backend_name("PyMuPDF4LLM") == "pymupdfllm"
    with pytest.raises(ValueError):
        fulltext.fulltexts(df, "none")


def test_trace_appends_and_streams(spark, tmp_path):
    at = str(tmp_path / "trace")
    for i in range(2):
        trace.append(spark, at, "r", f"T{i}", {"n": i}, {}, {}, "2024-01-01T00:00:00Z")
    trace.append(spark, at, "r", "T1", {"n": 1}, {}, {}, "2024-01-01T00:00:00Z")
    assert trace.events(spark, at).count() == 3
    q = trace.to_table(trace.deduplicated_stream(spark, at), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_files_and_pages(spark):
    f = spark.createDataFrame([("b", "p2", [1]), ("a", "p1", [])], "path string, paper_id string, contexts array<int>")
    assert tables.chosen_context_file(f).first()["path"] == "b" and tables.chosen_context_file(f, "p1").first()["path"] == "a"
    p = spark.createDataFrame([("p", ["a", "b", "c"])], "paper_id string, pages array<string>")
    assert tuple(tables.pages_kept(p, 2).first()) == ("p", "a\n\nb", 3, 2, True)
