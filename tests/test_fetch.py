"""Fetching passes with calls of their own, and against a server of this machine."""

import http.server
import json
import threading

import pytest

from lodestar.operators import honors, pdf
from lodestar.sources import fetch


class Pages(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        kind, body = {"/a": ("text/html; charset=windows-1252", "<p>café</p>".encode("cp1252")), "/b": ("application/pdf", b"%PDF"), "/c.pdf": ("application/pdf", b"%PDF-1" * 5000)}.get(self.path, (None, b""))
        self.send_response(200 if kind else 404)
        self.send_header("Content-Type", kind or "text/plain")
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_pages(spark, server):
    rows = spark.createDataFrame([(f"{server}/{x}",) for x in ("a", "a", "b", "none")] + [(None,)], "url string")
    got = {r["url"].rsplit("/", 1)[1]: r for r in fetch.fetched_pages(rows, render=lambda u: "dyn").collect()}
    assert got["a"]["html"] == "<p>café</p>" and got["a"]["dynamic_html"] == "dyn" and got["a"]["error"] is None
    assert got["b"]["error"] == "a PDF" and got["none"]["html"] is None and "404" in got["none"]["error"] and len(got) == 3


def test_first_usable_pdf_is_kept(spark, server, tmp_path):
    found = spark.createDataFrame(
        [("p1", "A Title", "great title study", 0, "unrelated", f"{server}/c.pdf"), ("p1", "A Title", "great title study", 1, "great title study", f"{server}/none"), ("p1", "A Title", "great title study", 2, "great title study", None), ("p1", "A Title", "great title study", 3, "great title study", f"{server}/c.pdf"), ("p2", "B", "other words here", 0, "other words here", f"{server}/none")],
        "paper_id string, paper_title string, query string, rank int, title string, pdf_url string",
    )
    for status in ("downloaded", "hit"):
        got = {r["paper_id"]: r for r in fetch.usable_pdfs(found, str(tmp_path)).collect()}
        # a file that is there counts for the first result that is about the query
        assert (got["p1"]["status"], got["p1"]["rank"], got["p1"]["size_bytes"]) == (status, 3 if status == "downloaded" else 1, 30_000)
        assert got["p2"]["status"] == "failed" and got["p2"]["path"] is None and "404" in got["p2"]["error"]
    assert [p.name for p in tmp_path.iterdir()] == [got["p1"]["filename"]]
    assert pdf.first_usable(found.select("query", "rank", "title", "pdf_url"), spark.createDataFrame([(f"{server}/c.pdf", True)], "pdf_url string, ok boolean")).count() == 1


def test_retries_wait_longer_each_time():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok"

    assert fetch.linear_retries(call, 2, sleep=waits.append) == "ok" and waits == [0.6, 1.2]
    with pytest.raises(RuntimeError, match="failed 1 times"):
        fetch.linear_retries(lambda: 1 / 0, 0)


def test_replies(spark):
    asked = []

    def post(url, body, headers, timeout):
        asked.append((url, body, headers))
        return {"choices": [{"message": {"content": "IEEE Fellow: Yes", "annotations": [{"type": "url_citation", "url_citation": {"url": "http://s"}}, {"type": "other"}]}}]}

    settings = {"model": "m", "base_url": "http://h/v1/", "api_key": "k"}
    assert fetch.chat(settings, post, "online")([]) == ("IEEE Fellow: Yes", ["http://s"]) and asked[0][1]["model"] == "m:online"
    assert asked[0][0] == "http://h/v1/chat/completions" and fetch.chat(settings, post, "plugins")([])[1] and asked[1][1]["plugins"]
    with pytest.raises(RuntimeError, match="the service says"):
        fetch.chat(settings, lambda *a: {"error": "no"}, retries=0)([])
    authors = spark.createDataFrame([("a", "Ann", "MIT", None), ("b", "Bob", None, None)], "author_key string, name string, affiliation string, institutions string")

    def search(messages):
        told = messages[0]["content"]
        if "Bob" in told:
            return ("ACM Fellow: Yes", ["http://two"]) if "at first" in told else ("ACM Fellow: Unknown", ["http://one"])
        return "IEEE Fellow: Yes", []

    got = {r["author_key"]: r for r in fetch.search_replies(authors, search, second_stage=True).collect()}
    assert (got["a"]["stage"], got["b"]["stage"], got["b"]["annotations"]) == (1, 2, ["http://two"])
    pages = authors.selectExpr("*", "'u' as url", "'text' as markdown")
    reply = json.dumps({"is_target_scholar": 1, "has_valid_profile_content": True, "fellow": {"AAAI Fellow": "yes", "acm": {"status": "No"}}})
    rows = fetch.page_replies(pages, lambda m: (reply, [])).withColumn("s", honors.reply_statuses(fetch.F.col("reply"))).collect()
    assert [tuple(r["s"]) for r in rows] == [("Unknown", "No", "Yes")] * 2
    bad = fetch.page_replies(pages, lambda m: 1 / 0).collect()
    assert all(r["reply"] is None and "division" in r["error"] for r in bad)


def test_main_content_of_a_page():
    from lodestar.functions import readable

    long = "This person works on graphs, on queries, and on very long sentences that say so."
    html = f"<html><head><title>t</title></head><body><nav><a href='x'>menu one two three four five six</a></nav><div id=side><ul><li><a href=y>a link that is long enough to count</a></li></ul></div><div><h2>About</h2><p>{long}</p><p>{long} <b>Bold</b> too.</p><ul><li>{long}</li></ul></div><footer><p>{long}</p></footer><script>var a;</script></body></html>"
    assert readable.as_markdown(html) == f"## About\n\n{long}\n\n{long} Bold too.\n\n- {long}"
    assert readable.as_text(html).startswith(f"About\n\n{long}") and readable.as_text(None) == "" and readable.as_text("<p>short</p>") == ""


def test_result_of_a_parsing_service():
    from lodestar.sources import fulltext

    assert fulltext.result_of({"a": {"md_content": "x"}}, "b") == {"md_content": "x"} and fulltext.result_of({"a": 1, "b": 2}, "b") == 2
    with pytest.raises(KeyError):
        fulltext.result_of({"a": 1, "c": 2}, "b")
