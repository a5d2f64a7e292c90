"""What needs a network, as passes over Arrow batches: pages, PDF files, and a model's replies.

Every function takes the call that reaches out as a parameter, so tests and closed clusters bring
their own. Spark may run a task twice: files appear under their name only when they are whole, and
replies must bear being asked for again.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import charsets, web
from ..functions import text as tx

#: Bytes that a download reads at once.
CHUNK = 8192
AGENT = {"User-Agent": "lodestar"}


def linear_retries(call: Callable[[], object], retries: int = 2, wait: float = 0.6, sleep: Callable[[float], None] = time.sleep) -> object:
    """The call's result; after the n-th failure it waits n times `wait`, after the last it raises."""
    for n in range(1, max(1, retries + 1) + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            if n > retries:
                raise RuntimeError(f"failed {n} times: {e}") from e
            sleep(wait * n)
    raise AssertionError


def open_url(url: str, timeout: float = 30) -> Iterator[bytes]:
    """The content type, then the content in chunks."""
    with urllib.request.urlopen(urllib.request.Request(url, headers=AGENT), timeout=timeout) as r:  # noqa: S310
        yield (r.headers.get("Content-Type") or "").encode()
        while chunk := r.read(CHUNK):
            yield chunk


# -- pages ------------------------------------------------------------------------------------------


def fetched_pages(urls: DataFrame, get: Callable[[str], Iterator[bytes]] = open_url, render: Callable[[str], str] | None = None) -> DataFrame:
    """(url, html, dynamic_html, charset, error) of each distinct url. A PDF is an error; render, if
    given, is a browser that returns a page as it looks once loaded."""
    schema = "url string, html string, dynamic_html string, charset string, error string"

    def one(url: str) -> tuple:
        html = name = error = dynamic = None
        try:
            kind, *chunks = get(url)
            if b"application/pdf" in kind.lower():
                raise ValueError("a PDF")
            html, name = charsets.decoded(b"".join(chunks), kind.decode("latin-1"))
            dynamic = render(url) if render else None
        except Exception as e:  # noqa: BLE001  the failure becomes a column
            error = str(e) or type(e).__name__
        return url, html, dynamic, name, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(u) for u in frame["url"]], columns=["url", "html", "dynamic_html", "charset", "error"])

    return urls.select("url").where("url is not null").distinct().mapInPandas(run, schema)


# -- PDF files --------------------------------------------------------------------------------------


def downloaded(url: str, target: Path, get: Callable[[str], Iterator[bytes]] = open_url) -> tuple[str, int]:
    """How a file came to be there (hit, downloaded) and its size."""
    if target.exists():
        return "hit", target.stat().st_size
    target.parent.mkdir(parents=True, exist_ok=True)
    own = target.with_name(f"{target.name}.{uuid.uuid4().hex}.part")
    try:
        chunks = iter(get(url))
        next(chunks)
        with own.open("wb") as f:
            for chunk in chunks:
                f.write(chunk)
        own.replace(target)
    finally:
        own.unlink(missing_ok=True)
    return "downloaded", target.stat().st_size


def usable_pdfs(found: DataFrame, folder: str, get: Callable[[str], Iterator[bytes]] = open_url) -> DataFrame:
    """The first PDF of each paper that can be had: found is (paper_id, paper_title, query, rank, title,
    pdf_url), as pdf.resolved gives it for papers' queries. Results whose title is not about the query
    and those without a PDF are passed over, the others are tried by rank until one succeeds.

    (paper_id, paper_title, filename, path, status, size_bytes, source_url, rank, result_title,
    tried, error): one row a paper that has such a result; folder must be one that all tasks share."""
    name = tx.pdf_filename(F.col("paper_id"), F.col("paper_title"))
    about = found.where(F.col("pdf_url").isNotNull() & web.title_relevant(F.col("title"), F.col("query")))
    choice = F.array_sort(F.collect_list(F.struct("rank", "pdf_url", "title")))
    papers = about.groupBy("paper_id", "paper_title").agg(choice.alias("choices")).withColumn("filename", name)
    columns = ["paper_id", "paper_title", "filename", "path", "status", "size_bytes", "source_url", "rank", "result_title", "tried", "error"]
    schema = "paper_id string, paper_title string, filename string, path string, status string, size_bytes long, source_url string, rank int, result_title string, tried int, error string"

    def one(paper_id: str, title: str, filename: str, choices: list) -> tuple:
        target, error = Path(folder, filename), None
        for n, c in enumerate(choices, 1):
            try:
                status, size = downloaded(c["pdf_url"], target, get)
                return paper_id, title, filename, str(target), status, size, c["pdf_url"], c["rank"], c["title"], n, None
            except Exception as e:  # noqa: BLE001  the next result may do
                error = str(e) or type(e).__name__
        return paper_id, title, filename, None, "failed", None, None, None, None, len(choices), error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(*r) for r in frame[["paper_id", "paper_title", "filename", "choices"]].itertuples(index=False)], columns=columns)

    return papers.select("paper_id", "paper_title", "filename", "choices").mapInPandas(run, schema)


# -- replies ----------------------------------------------------------------------------------------


def post_json(url: str, body: dict, headers: dict[str, str], timeout: float = 60) -> dict:
    told = urllib.request.Request(url, data=json.dumps(body).encode(), headers={"Content-Type": "application/json", **AGENT, **headers}, method="POST")
    with urllib.request.urlopen(told, timeout=timeout) as r:  # noqa: S310
        return json.loads(r.read().decode("utf-8", "replace"))


def chat(settings: dict, post: Callable[[str, dict, dict, float], dict] = post_json, search: str | None = None, retries: int = 2, sleep: Callable[[float], None] = time.sleep) -> Callable[[list[dict]], tuple[str, list[str]]]:
    """A client of a chat service: messages -> (reply, cited URLs). search: `online` asks for a model
    that looks things up, `plugins` for the service's own search."""
    model = settings["model"]
    body = {"model": f"{model}:online" if search == "online" and not model.endswith(":online") else model, "temperature": settings.get("temperature", 0), "max_tokens": settings.get("max_tokens", 256)}
    if settings.get("json_mode", True) and search is None:
        body["response_format"] = {"type": "json_object"}
    if search == "plugins":
        body["plugins"] = [{"id": "web", "max_results": settings.get("max_results", 5)}]
    where, headers = f"{settings['base_url'].rstrip('/')}/chat/completions", {"Authorization": f"Bearer {settings['api_key']}"}

    def ask(messages: list[dict]) -> tuple[str, list[str]]:
        answer = linear_retries(lambda: post(where, {**body, "messages": messages}, headers, settings.get("timeout", 60)), retries, sleep=sleep)
        if answer.get("error"):
            raise RuntimeError(f"the service says: {answer['error']}")
        message = (answer.get("choices") or [{}])[0].get("message")
        if not isinstance(message, dict):
            raise RuntimeError("an answer without a message")
        cited = [a.get("url_citation") or {} for a in message.get("annotations") or [] if isinstance(a, dict) and a.get("type") == "url_citation"]
        return message.get("content") or "", [c["url"] for c in cited if c.get("url")]

    return ask


PAGE_TASK = (
    "Decide from the page below whether the scholar is a Fellow of IEEE, ACM or AAAI. Reply with a JSON object: "
    'is_target_scholar (bool), has_valid_profile_content (bool), fellow: {"IEEE Fellow": {"status": "Yes|No|Unknown", "year": ""}, "ACM Fellow": ..., "AAAI Fellow": ...}.'
)
SEARCH_TASK = "Search the web: is the scholar an IEEE Fellow, an ACM Fellow, an AAAI Fellow? One line each, `IEEE Fellow: Yes|No|Unknown` and so on, then the sources."
SECOND_TASK = "Nothing was found at first. Look at lists of fellows, home pages and biographies, other spellings of the name too."


def about_scholar(name: str | None, affiliation: str | None, institutions: str | None) -> str:
    return f"Scholar name: {name or 'Unknown'}\nAffiliation: {affiliation or 'Unknown'}\nPaper institutions: {institutions or 'Unknown'}\n"


def page_replies(pages: DataFrame, ask: Callable[[list[dict]], tuple[str, list[str]]], retries: int = 2) -> DataFrame:
    """(author_key, url, reply, error) for pages (author_key, url, name, affiliation, institutions,
    markdown): what honors.local_lookup joins."""
    schema = "author_key string, url string, reply string, error string"

    def one(r) -> tuple:
        told = about_scholar(r.name, r.affiliation, r.institutions) + f"Source URL: {r.url}\nPage:\n{r.markdown}\n"
        error = None
        for _ in range(1 + retries):
            try:
                return r.author_key, r.url, ask([{"role": "system", "content": PAGE_TASK}, {"role": "user", "content": told}])[0], None
            except Exception as e:  # noqa: BLE001  the failure becomes a column
                error = str(e) or type(e).__name__
        return r.author_key, r.url, None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(r) for r in frame.itertuples(index=False)], columns=["author_key", "url", "reply", "error"])

    return pages.select("author_key", "url", "name", "affiliation", "institutions", "markdown").mapInPandas(run, schema)


def search_replies(authors: DataFrame, ask: Callable[[list[dict]], tuple[str, list[str]]], second_stage: bool = False) -> DataFrame:
    """(author_key, reply, annotations, stage, error) of a model that searches, for authors (author_key,
    name, affiliation, institutions). With second_stage it is asked again, more widely, where the
    first reply has no Yes."""
    schema = "author_key string, reply string, annotations array<string>, stage int, error string"

    def one(r) -> tuple:
        about, reply, cited, stage = about_scholar(r.name, r.affiliation, r.institutions), None, [], 1
        try:
            reply, cited = ask([{"role": "user", "content": f"{SEARCH_TASK}\n\n{about}"}])
            if second_stage and "yes" not in reply.lower():
                stage = 2
                again, more = ask([{"role": "user", "content": f"{SEARCH_TASK}\n{SECOND_TASK}\n\n{about}"}])
                if "yes" in again.lower():
                    reply, cited = again, more
        except Exception as e:  # noqa: BLE001  the failure becomes a column
            return r.author_key, reply, cited, stage, str(e) or type(e).__name__
        return r.author_key, reply, cited, stage, None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(r) for r in frame.itertuples(index=False)], columns=["author_key", "reply", "annotations", "stage", "error"])

    return authors.select("author_key", "name", "affiliation", "institutions").mapInPandas(run, schema)
