"""PDF to text through one of several backends; each is imported only where it runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

#: backend(content, max_pages, stem of the file's name) -> (pages of text, pages in the file)
Backend = Callable[[bytes, int | None, str], tuple[list[str], int]]
SCHEMA = "path string, text string, method string, page_count int, pages_used int, text_length int, truncated boolean, elapsed_s double, error string"
ALIASES = {"fitz": "pymupdf", "pymupdf4llm": "pymupdfllm", "pymupdf_llm": "pymupdfllm", "miner_u": "mineru", "magic-pdf": "mineru"}


def plain_pages(content: bytes, max_pages: int | None, stem: str = "") -> tuple[list[str], int]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        n = len(doc) if max_pages is None else min(len(doc), max_pages)
        return [doc[i].get_text() for i in range(n)], len(doc)


def markdown_pages(content: bytes, max_pages: int | None, stem: str = "") -> tuple[list[str], int]:
    import fitz
    import pymupdf4llm

    with fitz.open(stream=content, filetype="pdf") as doc:
        n = len(doc) if max_pages is None else min(len(doc), max_pages)
        return [pymupdf4llm.to_markdown(doc, pages=list(range(n)))], len(doc)


def service(url: str, timeout: float = 600) -> Backend:
    """A parsing service that takes a file and answers {results: {stem: {md_content}}}. A single result
    under another name counts too."""

    def run(content: bytes, max_pages: int | None, stem: str = "paper") -> tuple[list[str], int]:
        import requests

        answer = requests.post(url, files={"files": (f"{stem}.pdf", content)}, data={"end_page_id": (max_pages or 100_000) - 1}, timeout=timeout).json()
        one = result_of(answer.get("results") or {}, stem)
        return [one["md_content"]], int(one.get("page_count") or 0)

    return run


def result_of(results: dict, stem: str) -> dict:
    if stem not in results and len(results) != 1:
        raise KeyError(f"no result for {stem!r}")
    return results[stem] if stem in results else next(iter(results.values()))


BACKENDS: dict[str, Backend] = {"pymupdf": plain_pages, "pymupdfllm": markdown_pages}


def register(name: str, backend: Backend) -> None:
    BACKENDS[name] = backend


def backend_name(name: str) -> str:
    key = name.strip().lower().replace(" ", "_")
    return ALIASES.get(key, key)


def fulltexts(files: DataFrame, method: str = "pymupdfllm", max_pages: int | None = 20) -> DataFrame:
    """(path, text, …) of PDF files (path, content), as spark.read.format("binaryFile") gives them. A
    file that can't be read has an error and no text."""
    name = backend_name(method)
    if name not in BACKENDS:
        raise ValueError(f"no backend {method!r}")
    run = BACKENDS[name]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                began = time.time()
                try:
                    pages, n = run(bytes(content), max_pages, Path(path).stem)
                    text = "\n\n".join(pages)
                    used = n if max_pages is None else min(n, max_pages)
                    rows.append((path, text, name, n, used, len(text), used < n, time.time() - began, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, name, None, None, None, None, time.time() - began, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return files.select("path", "content").mapInPandas(read, SCHEMA)
