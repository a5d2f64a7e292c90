"""Text functions as Column -> Column. Patterns follow Python's Unicode rules, so `(?U)` where \\w, \\s
or \\b matter and `(?d)` where only a line feed ends a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a web query drops.
STOP_WORDS = ("pdf", "paper", "arxiv", "openreview", "ieee", "proceedings", "www", "http", "https")


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body and its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def squeezed(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    """Null for null, empty and blank strings."""
    return F.nullif(F.trim(c), F.lit(""))


def distinct_texts(items: Column) -> Column:
    """A list's texts, stripped, without blanks and repeats, in order."""
    return F.array_distinct(F.filter(F.transform(items, blank_to_null), lambda x: x.isNotNull()))


def title_norm(c: Column) -> Column:
    """Lower case, single blanks, no marks. Marks go without leaving a blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)\s+", " "), r"(?U)[^\w\s]", ""))


def alnum_norm(c: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else a single blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^0-9a-z]+", " "))


def author_norm(c: Column) -> Column:
    """Lower case; commas and dots are blanks."""
    return squeezed(F.translate(F.lower(F.coalesce(c, F.lit(""))), ",.", "  "))


def plain_norm(c: Column) -> Column:
    return squeezed(F.lower(F.coalesce(c, F.lit(""))))


def surname_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "")


def short_id(c: Column) -> Column:
    """The last path segment of a URL, or the id itself."""
    t = F.trim(c)
    return F.when(t.rlike("(?i)^https?://"), F.element_at(F.split(F.regexp_replace(t, "/+$", ""), "/"), -1)).otherwise(t)


def snippet(c: Column, limit: int = 260) -> Column:
    s = squeezed(c)
    return F.when(F.length(s) > limit, F.concat(F.left(s, F.lit(limit - 3)), F.lit("..."))).otherwise(s)


def truncated(c: Column, limit: int = 1200) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("...<truncated>"))).otherwise(c)


def slug(c: Column, limit: int = 80) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.trim(c), "[^a-zA-Z0-9._-]+", "_"), "^[_.-]+|[_.-]+$", "")
    return F.coalesce(F.nullif(F.left(s, F.lit(limit)), F.lit("")), F.lit("unknown"))


def inverted_index_text(c: Column) -> Column:
    """A map of word -> positions back to a text; words at one position keep the map's order."""
    pairs = F.flatten(F.transform(F.map_entries(c), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))))
    return F.nullif(F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " "), F.lit(""))


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w.-]+", "_"), "^_+|_+$", "")


def pdf_filename(paper_id: Column, title: Column) -> Column:
    name = lambda c, d: F.coalesce(F.nullif(safe_filename(F.coalesce(c, F.lit(""))), F.lit("")), F.lit(d))
    return F.concat(name(paper_id, "unknown"), F.lit("_"), name(title, "untitled"), F.lit(".pdf"))


def run_tag(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9-]+", "_"), "_+", "_"), "^_+|_+$", "")


def status_norm(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return F.when(s == "yes", "Yes").when(s == "no", "No").otherwise("Unknown")


def query_tokens(c: Column) -> Column:
    """Lower-case words of over two characters that are no stop words; repeats stay."""
    words = F.split(F.lower(c), r"(?U)\W+")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))


def name_tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: F.length(w) > 1)


def token_hits(text: Column, tokens: Column) -> Column:
    """How many tokens occur in the text, as parts of words too."""
    low = F.lower(text)
    return F.size(F.filter(tokens, lambda t: F.contains(low, t)))


def token_overlap(text: Column, tokens: Column) -> Column:
    """Hits over tokens; 1 where there are no tokens."""
    return F.when(F.size(tokens) == 0, F.lit(1.0)).otherwise(token_hits(text, tokens) / F.size(tokens))


def markdown_norm(c: Column, limit: int | None = None) -> Column:
    """Line feeds only, no blanks at line ends, no more than one empty line, no blank ends."""
    t = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "(?md)[ \t]+$", "")
    t = F.trim(F.regexp_replace(t, "\n{3,}", "\n\n"))
    t = F.regexp_replace(t, r"^\s+|\s+$", "")
    return F.left(t, F.lit(limit)) if limit else t


def paragraphs(c: Column) -> Column:
    """Wrapped lines of plain text joined; paragraphs part at empty lines."""
    t = F.regexp_replace(c, "\r\n?", "\n")
    parts = F.transform(F.split(t, r"\n[ \t]*(?:\n[ \t]*)+"), squeezed)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


def urls_in(c: Column) -> Column:
    """http(s) URLs in a text."""
    return F.regexp_extract_all(c, F.lit(r"""(?i)https?://[^\s)\]>"']+"""), F.lit(0))


def lenient_json(c: Column) -> Column:
    """The text as a JSON object, or what stands between the first { and the last }; else null."""
    whole = F.when(F.trim(c).startswith("{"), F.try_parse_json(c))
    return F.coalesce(whole, F.try_parse_json(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))))


def coerced_score(raw: Column, is_bool: Column | None = None) -> Column:
    """A score 0..10, rounded half to even; null where it is no number (booleans are none)."""
    value = F.bround(raw.try_cast("double")).cast("int")
    score = F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(10), value)))
    return score if is_bool is None else F.when(is_bool, F.lit(None).cast("int")).otherwise(score)


def mock_score(title: Column, context: Column) -> Column:
    """A stand-in score from the first byte of an MD5."""
    seed = F.md5(F.concat(F.coalesce(title, F.lit("")), F.lit("|"), F.coalesce(context, F.lit(""))).cast("binary"))
    return (F.conv(F.left(seed, F.lit(2)), 16, 10).cast("int") % 11).cast("int")


def line_of(text: Column, at: Column) -> Column:
    """1-based line of a 0-based offset."""
    head = F.substring(text, F.lit(1), at.cast("int"))
    return F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1


def column_of(text: Column, at: Column) -> Column:
    """1-based column: counted from the last line feed."""
    head = F.substring(text, F.lit(1), at.cast("int"))
    back = F.instr(F.reverse(head), "\n")
    return F.when(back == 0, at + 1).otherwise(back).cast("int")


def search_query(name: Column, affiliation: Column, institution: Column) -> Column:
    return squeezed(F.concat_ws(" ", name, blank_to_null(affiliation), blank_to_null(institution), F.lit("faculty profile homepage")))


def score_bucket(c: Column) -> Column:
    return F.when(c <= 3, "neg").when(c <= 6, "neutral").when(c.isNotNull(), "pos")


def fellow_text(status: Column) -> Column:
    part = lambda k: F.coalesce(F.nullif(status[k], F.lit("")), F.lit("Unknown"))
    return F.when(status.isNull(), "Unknown").otherwise(F.concat(F.lit("IEEE="), part("ieee"), F.lit(", ACM="), part("acm"), F.lit(", AAAI="), part("aaai")))


def self_citation_text(c: Column) -> Column:
    return F.when(c, "true").when(~c, "false").otherwise("unknown")


def honor_from_text(c: Column, org: str) -> Column:
    """Yes, No or Unknown for an organisation, from the first line that names it with a status, else
    from the text as a whole; null where it says nothing."""
    line = F.regexp_extract(c, rf"(?im)^.*?\b{org}\b[^\n]*?\b(yes|no|unknown)\b", 1)
    whole = F.regexp_extract(c, rf"(?is)\b{org}\b.*?\b(yes|no|unknown)\b", 1)
    return F.coalesce(F.nullif(line, F.lit("")), F.nullif(whole, F.lit("")))


def statuses(ieee: Column, acm: Column, aaai: Column) -> Column:
    """A normalised status struct."""
    return F.struct(status_norm(ieee).alias("ieee"), status_norm(acm).alias("acm"), status_norm(aaai).alias("aaai"))


def status_entry(entry: Column) -> Column:
    """Statuses of a map under either way of naming: 'ieee' or 'IEEE Fellow'."""
    of = lambda k: F.coalesce(F.try_element_at(entry, F.lit(k)), F.try_element_at(entry, F.lit(f"{k.upper()} Fellow")))
    return statuses(of("ieee"), of("acm"), of("aaai"))


def all_unknown(status: Column) -> Column:
    return (status["ieee"] == "Unknown") & (status["acm"] == "Unknown") & (status["aaai"] == "Unknown")


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>>: leftmost matches in code points from 0. The pieces between
    the matches and the matches themselves add up to the offsets, so no match is sliced twice."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, h: F.struct(F.length(g).alias("n"), h.alias("h")))
    pieces = F.filter(pieces, lambda x: x["h"].isNotNull())
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["n"]
        end = start + F.length(x["h"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["h"].alias("hit")))).alias("out"))

    return F.aggregate(pieces, zero, step, lambda a: a["out"])


def window_of(text: Column, start: Column, end: Column, width: int) -> Column:
    """The text from width before start to width after end, clipped."""
    a = F.greatest(F.lit(0), start - width)
    return F.substring(text, a + 1, F.least(F.length(text), end + width) - a)
