"""A REST source with cursor paging and retries, as a Spark data source, and LLM settings.

Nothing here is used without a network; tests pass a fetcher of their own.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIABLE = {429, 500, 502, 503, 504}
MAX_PER_PAGE = 200


class HttpError(RuntimeError):
    def __init__(self, status: int, retry_after: str | None = None):
        super().__init__(f"HTTP {status}")
        self.status, self.retry_after = status, retry_after


def fetch(url: str, timeout: float = 30) -> str:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
            return r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        raise HttpError(e.code, e.headers.get("Retry-After")) from e


def get_json(url: str, attempts: int = 4, backoff: float = 1.0, get: Callable[[str], str] = fetch, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A JSON answer. Busy servers are asked again after what they say, or after a doubling wait."""
    for n in range(1, attempts + 1):
        try:
            return json.loads(get(url))
        except HttpError as e:
            if e.status not in RETRIABLE or n == attempts:
                raise
            after = e.retry_after or ""
            sleep(float(after) if after.isdigit() else backoff * 2 ** (n - 1))
    raise AssertionError


def pages(base: str, params: dict[str, str], per_page: int = 200, max_pages: int | None = None, get: Callable[[str], dict] = get_json) -> Iterator[list[dict]]:
    """Pages of results by cursor, until one is empty, none follows, or max_pages."""
    cursor, n = "*", 0
    while cursor and (max_pages is None or n < max_pages):
        query = urllib.parse.urlencode({**params, "per-page": min(per_page, MAX_PER_PAGE), "cursor": cursor})
        answer = get(f"{base}?{query}")
        results = answer.get("results") or []
        if not results:
            return
        yield results
        cursor, n = (answer.get("meta") or {}).get("next_cursor"), n + 1


def bibliography_url(base: str, title: str, hits: int = 20, offset: int = 0, phrase: bool = True) -> str:
    return f"{base}?" + urllib.parse.urlencode({"q": f'"{title}"' if phrase else title, "format": "json", "h": hits, "f": offset})


class Filter(InputPartition):
    def __init__(self, expression: str):
        self.expression = expression


class RestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Filter]:
        """One partition per filter: `filters` is separated by line feeds."""
        return [Filter(x) for x in self.options.get("filters", "").split("\n") if x]

    def read(self, partition: Filter) -> Iterator[tuple]:
        params = {"filter": partition.expression} | ({"sort": self.options["sort"]} if "sort" in self.options else {})
        limit = self.options.get("maxPages")
        for page in pages(self.options["path"], params, int(self.options.get("perPage", 200)), int(limit) if limit else None):
            for row in page:
                yield partition.expression, json.dumps(row)


class RestSource(DataSource):
    """spark.dataSource.register(RestSource); spark.read.format("cursor_rest").option("path", url)
    .option("filters", "cites:W1\\ncites:W2").load() gives (filter, value), a row per result."""

    @classmethod
    def name(cls) -> str:
        return "cursor_rest"

    def schema(self) -> str:
        return "filter string, value string"

    def reader(self, schema) -> RestReader:
        return RestReader(self.options)


# -- settings -----------------------------------------------------------------------------------


def loose_int(value: object, default: int) -> int:
    try:
        return default if isinstance(value, bool) or value is None else int(str(value).strip())
    except ValueError:
        return default


def loose_bool(value: object, default: bool = False) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower() if value is not None else ""
    return True if text in {"1", "true", "yes", "on"} else False if text in {"0", "false", "no", "off"} else default


def read_yaml(path: str) -> dict:
    """A YAML file; sections of scalars where PyYAML is absent."""
    text = open(path, encoding="utf-8").read()
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        pass
    out: dict = {}
    section: dict = out
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#") or ":" not in bare:
            continue
        key, _, value = bare.partition(":")
        value = value.strip().strip("\"'")
        if not bare[0].isspace():
            section = out
        if value:
            section[key.strip()] = value
        else:
            section = out[key.strip()] = {}
    return out


def llm_settings(config: dict, prefix: str = "LODESTAR_LLM_", env: dict[str, str] | None = None) -> dict:
    """model, base_url, api_key, temperature, max_tokens, timeout, json_mode; the environment wins."""
    env = dict(os.environ) if env is None else env
    own = config.get("llm", config)
    pick = lambda k, d=None: env.get(prefix + k.upper(), own.get(k, d))
    return {"model": pick("model"), "base_url": pick("base_url"), "api_key": pick("api_key"), "temperature": float(pick("temperature", 0)), "max_tokens": loose_int(pick("max_tokens"), 256), "timeout": loose_int(pick("timeout"), 60), "json_mode": loose_bool(pick("json_mode"), True)}
