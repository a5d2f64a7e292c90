"""The main content of a page, by where its paragraphs are."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .web import DROPPED, VOID

#: Elements that are a block of their own, and what Markdown writes before them.
BLOCKS = {"p": "", "pre": "", "blockquote": "> ", "li": "- ", "dd": "", "dt": "", **{f"h{n}": "#" * n + " " for n in range(1, 7)}}
#: A block of fewer characters says nothing about its container.
LEAST = 25


class _Blocks(HTMLParser):
    """Blocks in order: the containers around each, its element, text, and how much of it is links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[tuple[str, int]] = []
        self.blocks: list[dict] = []
        self.serial = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self.handle_data("\n")
            return
        self.serial += 1
        self.path.append((tag, self.serial))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_data(self, data: str) -> None:
        if not data.strip() or any(t in DROPPED or t in ("head", "title", "table") for t, _ in self.path):
            return
        own = next((i for i in range(len(self.path) - 1, -1, -1) if self.path[i][0] in BLOCKS), None)
        at = own if own is not None else max((i for i, (t, _) in enumerate(self.path) if t not in ("a", "b", "i", "em", "strong", "span", "code", "sup", "sub", "u", "small")), default=-1)
        key = self.path[at][1] if at >= 0 else 0
        if not self.blocks or self.blocks[-1]["key"] != key:
            around = [k for _, k in self.path[: at if own is not None else at + 1]]
            self.blocks.append({"key": key, "tag": self.path[at][0] if own is not None else "p", "around": around, "text": [], "links": 0})
        block = self.blocks[-1]
        block["text"].append(data)
        if any(t == "a" for t, _ in self.path):
            block["links"] += len(data.strip())


def main_blocks(html: str | None) -> list[tuple[str, str]]:
    """(element, text) of the blocks of the container whose paragraphs weigh most: long ones, with
    commas, not made of links. A container has half the weight of those within it."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    weight: dict[int, float] = {}
    for b in parser.blocks:
        b["line"] = " ".join("".join(b["text"]).split())
        n = len(b["line"])
        if n >= LEAST and b["around"]:
            worth = (1 + b["line"].count(",") + min(n / 100, 3)) * (1 - min(1.0, b["links"] / n))
            for k, share in zip(reversed(b["around"]), (1, 0.5), strict=False):
                weight[k] = weight.get(k, 0) + worth * share
    if not weight or max(weight.values()) <= 0:
        return []
    best = max(weight, key=lambda k: (weight[k], -k))
    return [(b["tag"], b["line"]) for b in parser.blocks if best in b["around"] and b["line"] and b["links"] <= 0.5 * len(b["line"])]


def as_markdown(html: str | None) -> str:
    return "\n\n".join(BLOCKS.get(tag, "") + line for tag, line in main_blocks(html))


def as_text(html: str | None) -> str:
    return "\n\n".join(line for _, line in main_blocks(html))


@F.pandas_udf(T.StringType())
def main_markdown(html: pd.Series) -> pd.Series:
    return html.map(as_markdown)


@F.pandas_udf(T.StringType())
def main_text(html: pd.Series) -> pd.Series:
    return html.map(as_text)
