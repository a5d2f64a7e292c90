"""URL and page functions as Column -> Column."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

#: Hosts whose pages are no profiles, and words of profile URLs and titles.
BLOCKED_HOSTS = ("ieee.org", "acm.org", "aaai.org", "dblp.org", "openreview.net", "arxiv.org", "scholar.google.")
PROFILE_URL_HINTS = ("faculty", "people", "person", "profile", "homepage", "home", "bio", "about", "cv", "staff")
PROFILE_TITLE_HINTS = ("prof", "professor", "faculty", "bio", "homepage", "curriculum vitae", "research", "staff")
#: Parts of a path or query that promise a PDF.
PDF_HINTS = ("pdf?", "format=pdf", "type=pdf", "/download/pdf", "pdf-download", "pdf_file=")
NOISE_TERMS = ("home", "menu", "about", "news", "contact", "copyright")


def _any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def query(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))


def path_depth(url: Column) -> Column:
    return F.size(F.filter(F.split(path(url), "/"), lambda s: s != ""))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(F.trim(url), "#.*$", "")


def unwrapped(url: Column) -> Column:
    """The target of a search engine's redirect link, or the URL itself."""
    target = F.nullif(F.regexp_extract(query(url), "(?:^|&)uddg=([^&]*)", 1), F.lit(""))
    is_redirect = F.contains(host(url), F.lit("duckduckgo.com")) & path(url).startswith("/l")
    return F.when(is_redirect & target.isNotNull(), F.coalesce(F.try_url_decode(target), url)).otherwise(url)


def is_openreview(url: Column) -> Column:
    return F.contains(host(url), F.lit("openreview.net"))


def is_arxiv(url: Column) -> Column:
    return F.contains(host(url), F.lit("arxiv.org"))


def is_pdf(url: Column) -> Column:
    return F.element_at(F.split(F.lower(url), r"\?", 2), 1).endswith(".pdf")


def is_pdf_like(url: Column) -> Column:
    q = query(url)
    whole = F.lower(F.concat(path(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))
    return is_pdf(url) | (is_openreview(url) & path(url).startswith("/pdf")) | _any(whole, PDF_HINTS)


def arxiv_pdf(url: Column) -> Column:
    """The PDF of an arXiv abstract or PDF page, else null."""
    u = unwrapped(url)
    p = path(u)
    number = F.regexp_replace(F.regexp_extract(p, "^/abs/(.*)$", 1), "^/+|/+$", "")
    straight = F.concat(F.lit("https://arxiv.org"), p, F.when(F.lower(p).endswith(".pdf"), "").otherwise(".pdf"))
    return F.when(is_arxiv(u) & p.startswith("/pdf/"), straight).when(is_arxiv(u) & p.startswith("/abs/") & (number != ""), F.concat(F.lit("https://arxiv.org/pdf/"), number, F.lit(".pdf")))


def openreview_pdf(url: Column) -> Column:
    """The PDF of an OpenReview forum page, the URL itself where it is one, else null."""
    number = F.nullif(F.regexp_extract(query(url), "(?:^|&)id=([^&]+)", 1), F.lit(""))
    forum = is_openreview(url) & path(url).startswith("/forum") & number.isNotNull()
    return F.when(is_openreview(url) & path(url).startswith("/pdf"), url).when(forum, F.concat(F.lit("https://openreview.net/pdf?id="), number))


def is_wikipedia(url: Column) -> Column:
    return F.contains(host(url), F.lit("wikipedia.org"))


def is_blocked(url: Column) -> Column:
    """Digital libraries and PDFs; hosts are looked for in the whole URL."""
    low = F.lower(url)
    return _any(low, BLOCKED_HOSTS) | F.lower(path(url)).endswith(".pdf")


def has_profile_hint(url: Column, title: Column) -> Column:
    return _any(F.lower(F.coalesce(url, F.lit(""))), PROFILE_URL_HINTS) | _any(F.lower(F.coalesce(title, F.lit(""))), PROFILE_TITLE_HINTS)


def tokens_met(tokens: Column, *texts: Column) -> Column:
    """Tokens that occur in one of the texts."""
    low = [F.lower(F.coalesce(t, F.lit(""))) for t in texts]

    def met(t: Column) -> Column:
        out = F.lit(False)
        for x in low:
            out = out | F.contains(x, t)
        return out

    return F.size(F.filter(tokens, met))


def is_personal(url: Column, title: Column, tokens: Column) -> Column:
    met = tokens_met(tokens, url, title) >= 1
    academic = F.contains(host(url), F.lit(".edu")) | F.contains(host(url), F.lit("cs."))
    return F.contains(path(url), F.lit("/~")) | ((path_depth(url) <= 2) & met & academic) | (has_profile_hint(url, title) & met)


def admission(url: Column, allow_wikipedia: bool) -> Column:
    """Why a search result is no candidate page, or `ok`."""
    u = without_fragment(unwrapped(url))
    return (
        F.when(~u.rlike("^https?://"), "invalid_scheme")
        .when(is_blocked(u), "blocked_domain_or_pdf")
        .when(is_wikipedia(u) & F.lit(not allow_wikipedia), "wikipedia_disabled")
        .otherwise("ok")
    )


def candidate_score(url: Column, title: Column, tokens: Column) -> Column:
    low_url, low_title = F.lower(url), F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(is_wikipedia(url), -20).otherwise(20)
        + F.when(F.contains(low_url, F.lit(".edu")), 12).otherwise(0)
        + F.when(_any(low_url, PROFILE_URL_HINTS), 8).otherwise(0)
        + F.when(_any(low_title, PROFILE_TITLE_HINTS), 8).otherwise(0)
        + F.least(tokens_met(tokens, url, title) * 4, F.lit(20))
    )


def title_relevant(title: Column, q: Column, min_hits: int = 3, min_overlap: float = 0.6) -> Column:
    tokens = tx.query_tokens(q)
    return (F.when(F.size(tokens) > 0, tx.token_hits(title, tokens)).otherwise(0) >= min_hits) & (tx.token_overlap(title, tokens) >= min_overlap)


def page_relevant(html: Column, q: Column, min_hits: int = 3, min_overlap: float = 0.6) -> Column:
    tokens = tx.query_tokens(q)
    plain = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")
    return (F.size(tokens) > 0) & (tx.token_hits(plain, tokens) >= min_hits) & (tx.token_overlap(plain, tokens) >= min_overlap)


@F.pandas_udf(T.StringType())
def joined_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link seen from its page; null where it is no URL."""

    def one(b: str | None, u: str | None) -> str | None:
        try:
            return urljoin(b or "", u or "")
        except ValueError:
            return None

    return pd.Series([one(b, u) for b, u in zip(base, link, strict=True)])


def links_in(html: Column) -> Column:
    """Targets of href and src, then of content that ends in .pdf, as they stand."""
    h = F.coalesce(html, F.lit(""))
    return F.concat(F.regexp_extract_all(h, F.lit(r"""(?i)(?:href|src)=["']([^"']+)["']"""), F.lit(1)), F.regexp_extract_all(h, F.lit(r"""(?i)content=["']([^"']+\.pdf)["']"""), F.lit(1)))


#: Elements whose text is no content.
DROPPED = {"script", "style", "nav", "footer", "header", "aside", "form", "noscript", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BREAKS = {"p", "div", "li", "ul", "ol", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "br", "blockquote", "pre"}


class _Body(HTMLParser):
    """Texts of main, article and body, apart."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.muted = 0
        self.depth = {"main": 0, "article": 0, "body": 0}
        self.out: dict[str, list[str]] = {"main": [], "article": [], "body": [], "all": []}

    def _put(self, s: str) -> None:
        self.out["all"].append(s)
        for k, n in self.depth.items():
            if n:
                self.out[k].append(s)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in DROPPED and tag not in VOID:
            self.muted += 1
        elif not self.muted:
            if tag in self.depth:
                self.depth[tag] += 1
            if tag in BREAKS:
                self._put("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.muted = max(0, self.muted - 1)
        elif not self.muted:
            if tag in BREAKS:
                self._put("\n")
            if tag in self.depth:
                self.depth[tag] = max(0, self.depth[tag] - 1)

    def handle_data(self, data: str) -> None:
        if not self.muted:
            self._put(data)


def body_text_of(html: str | None) -> str:
    """The text of main, else article, else body, else all; a line for each block."""
    parser = _Body()
    parser.feed(html or "")
    parser.close()
    for k in ("main", "article", "body", "all"):
        lines = [" ".join(x.split()) for x in "".join(parser.out[k]).split("\n")]
        if text := "\n".join(x for x in lines if x):
            return text
    return ""


@F.pandas_udf(T.StringType())
def body_text(html: pd.Series) -> pd.Series:
    return html.map(body_text_of)


def keyword_windows(text: Column, keywords: tuple[str, ...], before: int = 1200, after: int = 2600) -> Column:
    """What stands around the first place of each keyword: [pos - before, pos + after], overlapping
    windows merged. Without a keyword, nothing."""
    low = F.lower(text)
    place = lambda k: F.locate(k, low) - 1
    found = F.array(*[F.when(place(k) >= 0, F.struct(F.greatest(F.lit(0), place(k) - before).alias("a"), F.least(F.length(text), place(k) + after).alias("b"))) for k in keywords])
    found = F.filter(found, lambda w: w.isNotNull())
    kind = "array<struct<a:int,b:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        return F.when((F.size(acc) > 0) & (x["a"] <= last["b"]), joined).otherwise(F.concat(acc, F.array(x)))

    cut = lambda ws: F.array_join(F.transform(ws, lambda w: F.substring(text, w["a"] + 1, w["b"] - w["a"])), "\n\n")
    return tx.let(F.aggregate(F.array_sort(found), F.array().cast(kind), step), cut)


def page_quality(text: Column, name: Column, affiliation: Column, institutions: Column) -> Column:
    """How likely a page's text is the profile of a person."""
    low = F.lower(F.coalesce(text, F.lit("")))
    norm = tx.plain_norm(text)
    aff, inst = tx.plain_norm(affiliation), tx.plain_norm(F.element_at(F.split(F.coalesce(institutions, F.lit("")), ";", 2), 1))
    yes = lambda c, n: F.when(c, n).otherwise(0)
    fellow = sum((yes(low.rlike(p), 1) for p in (r"\bacm\s+fellow\b", r"\bieee\s+fellow\b", r"\baaai\s+fellow\b", r"\bacm\s*/\s*ieee\s*fellow\b")), F.lit(0))
    n = F.length(low)
    noise = sum(((n - F.length(F.replace(low, F.lit(t), F.lit("")))) / len(t) for t in NOISE_TERMS), F.lit(0.0))
    ratio = F.when(n > 0, noise / F.greatest(F.lit(1), F.floor(n / 50))).otherwise(0.0)
    return (
        F.least(F.size(F.filter(tx.name_tokens(name), lambda t: F.contains(low, t))) * 4, F.lit(16))
        + yes((aff != "") & F.contains(norm, aff), 8)
        + yes((inst != "") & F.contains(norm, inst), 6)
        + F.least(fellow * 20, F.lit(40))
        + yes(F.contains(low, F.lit("biography")), 6)
        + yes(F.contains(low, F.lit("professor")), 4)
        + F.when(n.between(400, 12000), 10).when(n > 12000, 6).when(n >= 180, 4).otherwise(0)
        - yes(ratio > 0.4, 6)
    ).cast("int")
