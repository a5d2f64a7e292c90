"""Bibliographies and citation contexts: from a paper's text to the places where it cites a target.

All of it is column expressions on arrays of spans; only the similarity ratio needs Python, and only
for entries that no cheaper test decides. Offsets are code points from 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx

#: Headings, markers of entries, citations. Java syntax with Python's meaning.
_TITLE = r"(?:References(?:\s+(?:and|&)\s+Notes)?|Bibliography)"
HEADING = rf"(?imdU)^\s*(?:#{{1,6}}\s*)?(?:\*\*\s*{_TITLE}\s*\*\*|{_TITLE})\s*$"
ENTRY = r"(?mdU)^\s*(?:[-*•]\s+)?\[(\d+)\]\s+"
ENTRY_INLINE = r"(?U)\.\s+\[(\d+)\]\s+"
NUMBERED = r"(?mdU)^\s*(?:[-*•]\s+)?(\d{1,3})[.)]\s+"
NUMBERED_INLINE = r"(?U)(?<!\S)(\d{1,3})[.)]\s+"
LISTED = r"(?mdU)^\s*(?:[-*•]\s+|\d+[.)]\s+)"
LEADING = r"(?U)^\s*(?:(?:[-*•]\s+)?\[\d+\]\s+|[-*•]\s+|\d+[.)]\s+)"
YEAR = r"(?U)\b(?:19|20)\d{2}[a-z]?\b"
BRACKET = r"(?U)\[\s*(\d(?:[\d\s,;–−-]*\d)?)\s*\]"
PAREN = r"(?U)\(([^()]*\b(?:19|20)\d{2}[a-z]?\b[^()]*)\)"
NARRATIVE = r"(?U)\b([A-Z][A-Za-z'`-]+)(?:\s+et\s+al\.?)?(?:\s+(?:and|&)\s+[A-Z][A-Za-z'`-]+)?\s*\(\s*([^)]*?\b(?:19|20)\d{2}[a-z]?\b[^)]*?)\s*\)"
SUFFIXES = r"(?U)\b(?:19|20)\d{2}[a-z](?:\s*,\s*[a-z])+\b"
NO_HEADING = "references heading not found"

ENTRIES = "array<struct<ref_id:int,raw_text:string>>"
CONTEXTS = "array<struct<ref_id:int,match_text:string,start:int,end:int,line:int,col:int,context:string>>"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


# -- splitting ----------------------------------------------------------------------------------


def split_text(text: Column) -> Column:
    """struct<body, references> at the last heading that stands alone; null without one."""
    def at_last(heads: Column) -> Column:
        last = F.try_element_at(heads, F.lit(-1))
        return F.when(F.size(heads) > 0, F.struct(F.substring(text, F.lit(1), last["start"]).alias("body"), F.substring(text, last["end"] + 1, F.length(text)).alias("references")))

    return tx.let(tx.spans(text, HEADING), at_last)


def _line_starts(text: Column) -> Column:
    """array<struct<at, line>> of the lines that a line feed ends."""
    kind = "array<struct<at:int,line:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    step = lambda a, x: F.struct((a["at"] + F.length(x) + 1).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("at"), x.alias("line")))).alias("out"))
    return F.aggregate(F.split(text, "\n", -1), zero, step, lambda a: a["out"])


def _sliced(text: Column, markers: Column) -> Column:
    """Entries between markers (struct<at, ord, id>): sorted, one for a place, blank ones dropped."""
    single = tx.let(F.array_sort(markers), lambda ordered: F.filter(ordered, lambda m, i: (i == 0) | (m["at"] != F.get(ordered, i - 1)["at"])))
    cut = tx.let(single, lambda all_: F.transform(all_, lambda m, i: F.struct(m["id"].alias("ref_id"), stripped(F.substring(text, m["at"] + 1, F.coalesce(F.get(all_, i + 1)["at"], F.length(text)) - m["at"])).alias("raw_text"))))
    return F.filter(cut, lambda e: e["raw_text"] != "")


def _by_starts(text: Column, starts: Column) -> Column:
    """Entries between offsets, numbered by place; what stands before the first is one too."""
    def whole(given: Column) -> Column:
        first = F.try_element_at(given, F.lit(1))
        return F.when((first != 0) & (stripped(F.substring(text, F.lit(1), first)) != ""), F.concat(F.array(F.lit(0)), given)).otherwise(given)

    cut = tx.let(tx.let(starts, whole), lambda all_: F.transform(all_, lambda a, i: F.struct((i + 1).alias("ref_id"), stripped(F.substring(text, a + 1, F.coalesce(F.get(all_, i + 1), F.length(text)) - a)).alias("raw_text"))))
    return F.filter(cut, lambda e: e["raw_text"] != "")


def _marked(text: Column, pattern: str, order: int, at_bracket: bool = False) -> Column:
    def one(s: Column) -> Column:
        at = s["start"] + (F.locate("[", s["hit"]) - 1 if at_bracket else F.lit(0))
        return F.struct(at.alias("at"), F.lit(order).alias("ord"), F.regexp_extract(s["hit"], r"(?U)(\d+)", 1).try_cast("int").alias("id"))

    return F.transform(tx.spans(text, pattern), one)


def _blocks(text: Column) -> Column:
    """Texts between empty lines; one of under 20 characters joins the next."""
    parts = F.filter(F.transform(F.split(text, r"(?U)\n\s*\n+"), stripped), lambda s: s != "")
    rows = tx.let(parts, lambda all_: F.transform(all_, lambda s, i: F.struct(s.alias("s"), (i + 1 == F.size(all_)).alias("last"))))
    zero = F.struct(F.lit("").alias("held"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        whole = F.when(a["held"] == "", x["s"]).otherwise(F.concat(a["held"], F.lit("\n"), x["s"]))
        short = (F.length(whole) < 20) & ~x["last"]
        return F.struct(F.when(short, whole).otherwise("").alias("held"), F.when(short, a["out"]).otherwise(F.concat(a["out"], F.array(whole))).alias("out"))

    return F.aggregate(rows, zero, step, lambda a: a["out"])


def with_entries(df: DataFrame, references: str = "references") -> DataFrame:
    """df with `entries` and `parse_method`, by the first way of splitting that finds any."""
    text = F.col(references)
    numeric = F.concat(_marked(text, ENTRY, 0), _marked(text, ENTRY_INLINE, 1, at_bracket=True))
    lines = F.filter(_line_starts(text), lambda x: x["line"].rlike(NUMBERED))
    inline = F.flatten(F.transform(lines, lambda x: F.transform(_marked(F.concat(x["line"], F.lit("\n")), NUMBERED_INLINE, 1), lambda m: F.struct((x["at"] + m["at"]).alias("at"), m["ord"].alias("ord"), m["id"].alias("id")))))
    numbered = F.concat(_marked(text, NUMBERED, 0), inline)
    anchors = F.transform(F.filter(_line_starts(text), lambda x: x["line"].rlike(YEAR) & (x["line"].rlike(LEADING) | x["line"].rlike(r"(?U)^\s*\p{Lu}"))), lambda x: x["at"])
    items = F.transform(tx.spans(text, LISTED), lambda s: s["start"])
    # each way is a column of its own, so that Spark works it out once
    out = df.withColumns({"__n": F.coalesce(numeric, F.array().cast("array<struct<at:int,ord:int,id:int>>"))})
    out = out.withColumns({"__l": F.when(F.size("__n") == 0, numbered)})
    out = out.withColumns({"__b": F.when((F.size("__n") == 0) & (F.coalesce(F.size("__l"), F.lit(0)) == 0), _blocks(text))})
    open_ = (F.size("__n") == 0) & (F.coalesce(F.size("__l"), F.lit(0)) == 0) & (F.coalesce(F.size("__b"), F.lit(0)) < 2)
    out = out.withColumns({"__y": F.when(open_, anchors), "__i": F.when(open_, items)})
    none = F.array().cast(ENTRIES)
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    whole = stripped(text)
    method = (
        F.when(some("__n"), "numeric").when(some("__l"), "numeric_list").when(F.coalesce(F.size("__b"), F.lit(0)) >= 2, "blank_lines")
        .when(some("__y"), "year_anchors").when(some("__i"), "list_items").when(F.coalesce(whole, F.lit("")) != "", "single_entry").otherwise("empty")
    )
    entries = (
        F.when(some("__n"), _sliced(text, F.col("__n"))).when(some("__l"), _sliced(text, F.col("__l")))
        .when(F.coalesce(F.size("__b"), F.lit(0)) >= 2, F.transform("__b", lambda s, i: F.struct((i + 1).alias("ref_id"), s.alias("raw_text"))))
        .when(some("__y"), _by_starts(text, F.array_sort(F.array_distinct("__y")))).when(some("__i"), _by_starts(text, F.array_sort(F.array_distinct("__i"))))
        .when(F.coalesce(whole, F.lit("")) != "", F.array(F.struct(F.lit(1).alias("ref_id"), whole.alias("raw_text")))).otherwise(none)
    )
    return out.withColumns({"parse_method": method, "entries": entries}).drop("__n", "__l", "__b", "__y", "__i")


def first_author(raw: Column) -> Column:
    clean = stripped(F.regexp_replace(raw, LEADING, ""))
    return F.nullif(F.regexp_extract(clean, "^([A-Z][A-Za-z'`-]+)", 1), F.lit(""))


def year_token(raw: Column) -> Column:
    """The first year with its letter, if it has one."""
    return F.lower(F.nullif(F.regexp_extract(F.regexp_replace(raw, LEADING, ""), YEAR, 0), F.lit("")))


def author_year_key(raw: Column) -> Column:
    """author|year in lower case; null unless the entry has both."""
    return F.concat(F.lower(first_author(raw)), F.lit("|"), year_token(raw))


def entry_table(df: DataFrame) -> DataFrame:
    """A row for each entry, with what it tells."""
    rows = df.select("paper_id", F.posexplode("entries").alias("entry_pos", "e")).select("paper_id", "entry_pos", "e.*")
    raw = F.col("raw_text")
    return rows.withColumns({"first_author": first_author(raw), "year": F.left(year_token(raw), F.lit(4)), "year_suffix": F.nullif(F.substring(year_token(raw), 5, 1), F.lit("")), "author_year_key": author_year_key(raw)})


# -- matching -----------------------------------------------------------------------------------


def matched_entries(entries: DataFrame, titles: DataFrame, threshold: float = 0.8) -> DataFrame:
    """For each paper of titles (paper_id, title) its best entry, if good enough: 1 where the title
    stands in it, else the higher of the share of its words found and the ratio. A ratio can't change
    the outcome where it stays below the recall, so it is computed only where lengths allow more."""
    rows = entries.join(titles, "paper_id").withColumns({"__t": tx.alnum_norm(F.col("title")), "__e": tx.alnum_norm(F.col("raw_text"))})
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    recall = F.size(F.array_intersect(words(F.col("__t")), words(F.col("__e")))) / F.size(words(F.col("__t")))
    rows = rows.withColumn("__r", F.when(F.col("__t") == "", 0.0).when(F.contains("__e", "__t"), 1.0).otherwise(recall))
    needs = (F.col("__r") < 1.0) & (F.col("__t") != "") & (sim.best_possible(F.col("__t"), F.col("__e")) > F.col("__r"))
    compared = rows.where(needs).withColumn("score", F.greatest("__r", sim.ratio(F.col("__t"), F.col("__e"))))
    rest = rows.where(~needs).withColumn("score", F.col("__r"))
    both = rest.unionByName(compared)
    place = Window.partitionBy("paper_id").orderBy(F.desc("score"), "entry_pos")
    return both.withColumn("__n", F.row_number().over(place)).where((F.col("__n") == 1) & (F.col("score") >= threshold)).drop("__n", "__t", "__e", "__r")


# -- contexts -----------------------------------------------------------------------------------


def names_id(inner: Column, ref_id: Column) -> Column:
    """Whether a list of numbers and ranges names an id; ranges may run either way."""
    parts = F.transform(F.split(inner, "[;,]"), lambda p: stripped(p))

    def one(p: Column) -> Column:
        lo = F.regexp_extract(p, r"(?U)^(\d+)\s*[–−-]\s*(\d+)$", 1).try_cast("int")
        hi = F.regexp_extract(p, r"(?U)^(\d+)\s*[–−-]\s*(\d+)$", 2).try_cast("int")
        return F.coalesce(ref_id.between(F.least(lo, hi), F.greatest(lo, hi)), F.when(p.rlike(r"^\d+$"), p.try_cast("int") == ref_id), F.lit(False))

    return F.exists(parts, one)


def _context(text: Column, s: Column, ref_id: Column, width: int) -> Column:
    return F.struct(ref_id.cast("int").alias("ref_id"), s["hit"].alias("match_text"), s["start"].alias("start"), s["end"].alias("end"), tx.line_of(text, s["start"]).alias("line"), tx.column_of(text, s["start"]).alias("col"), tx.window_of(text, s["start"], s["end"], width).alias("context"))


def numeric_contexts(body: Column, ref_id: Column, width: int = 512) -> Column:
    met = F.filter(tx.spans(body, BRACKET), lambda s: names_id(F.regexp_extract(s["hit"], BRACKET, 1), ref_id))
    return F.transform(met, lambda s: _context(body, s, ref_id, width))


def year_tokens(text: Column) -> Column:
    """Years with letters; `2019a, b` is two."""
    lists = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SUFFIXES), F.lit(0)), lambda h: F.transform(F.split(F.substring(h, 5, 1000), r"\s*,\s*"), lambda x: F.concat(F.left(h, F.lit(4)), F.trim(x)))))
    return F.transform(F.array_distinct(F.concat(lists, F.regexp_extract_all(text, F.lit(YEAR), F.lit(0)))), F.lower)


def _item_names(item: Column, surname: Column, year: Column) -> Column:
    clean = F.regexp_replace(stripped(item), r"(?iU)^(?:e\.g\.|i\.e\.|see|cf\.|see also)\s+", "")
    own = F.regexp_extract(clean, "^([A-Z][A-Za-z'`-]+)", 1)
    return (own != "") & (tx.surname_norm(own) == surname) & F.array_contains(year_tokens(item), year)


def author_year_contexts(body: Column, ref_id: Column, surname: Column, year: Column, width: int = 512) -> Column:
    """Contexts of citations in parentheses, then of narrative ones; a span counts once."""
    target, when = tx.surname_norm(surname), F.lower(year)
    inside = lambda s: F.exists(F.split(stripped(F.regexp_extract(s["hit"], PAREN, 1)), r"(?U)\s*;\s*"), lambda item: _item_names(item, target, when))
    told = lambda s: (tx.surname_norm(F.regexp_extract(s["hit"], NARRATIVE, 1)) == target) & F.array_contains(year_tokens(F.regexp_extract(s["hit"], NARRATIVE, 2)), when)
    found = F.array_distinct(F.concat(F.filter(tx.spans(body, PAREN), inside), F.filter(tx.spans(body, NARRATIVE), told)))
    return F.when((target != "") & (when != ""), F.transform(found, lambda s: _context(body, s, ref_id, width))).otherwise(F.array().cast(CONTEXTS))


def reference_contexts(papers: DataFrame, width: int = 512, threshold: float = 0.8, style: str = "auto", cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """papers (paper_id, text, title) with ref_id, match_score, reference_entry, contexts,
    citation_style, author_year_key, parse_method, num_entries, locators, errors and error. Numbers
    locate only where the bibliography has them. cut may write parsed papers as a table, so that they
    are parsed once and plans stay short."""
    if style not in ("auto", "numeric", "author_year"):
        raise ValueError(f"citation style {style!r}")
    base = papers.select("paper_id", "title", split_text(F.col("text")).alias("parts"))
    parsed = with_entries(base.select("paper_id", "title", F.col("parts.body").alias("body"), F.col("parts.references").alias("references"), F.col("parts").isNull().alias("headless")))
    parsed = cut(parsed)
    best = matched_entries(entry_table(parsed.where(~F.col("headless"))), papers.select("paper_id", "title"), threshold)
    rows = parsed.join(best.select("paper_id", "ref_id", "raw_text", "score", "first_author", F.concat("year", F.coalesce("year_suffix", F.lit(""))).alias("when")), "paper_id", "left")
    has_numbers = F.col("parse_method").isin("numeric", "numeric_list") & F.lit(style != "author_year")
    has_names = F.col("first_author").isNotNull() & F.col("when").isNotNull() & F.lit(style != "numeric")
    none = F.array().cast(CONTEXTS)
    met = F.col("ref_id").isNotNull()
    found = F.concat(F.when(met & has_numbers, numeric_contexts(F.col("body"), F.col("ref_id"), width)).otherwise(none), F.when(met & has_names, author_year_contexts(F.col("body"), F.col("ref_id"), F.col("first_author"), F.col("when"), width)).otherwise(none))
    locators = F.when(met, F.filter(F.array(F.when(has_numbers, "numeric"), F.when(has_names, "author_year")), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    errors = F.when(F.col("headless"), F.array().cast("array<string>")).otherwise(F.filter(F.array(F.when(F.size("entries") == 0, "no_reference_entries"), F.when((F.size("entries") > 0) & ~met, "title_match_failed"), F.when(met & (F.size(locators) == 0), "no_locator_available")), lambda x: x.isNotNull()))
    return rows.select(
        "paper_id", F.col("title").alias("query_title"), "ref_id", F.coalesce("score", F.lit(0.0)).alias("match_score"), tx.squeezed(F.col("raw_text")).alias("reference_entry"), F.array_distinct(found).alias("contexts"),
        F.when(F.size(locators) == 2, "mixed").otherwise(F.try_element_at(locators, F.lit(1))).alias("citation_style"),
        F.concat("first_author", F.lit("|"), "when").alias("author_year_key"), "parse_method", F.size("entries").alias("num_entries"), locators.alias("locators"), errors.alias("errors"), F.when(F.col("headless"), NO_HEADING).alias("error"),
    )


def with_second_title(first: DataFrame, second: DataFrame) -> DataFrame:
    """Results for the matched title, but those for the query title where the first found no entry (an
    id of 0 counts as none) and the second did, or scored better."""
    missing = (F.coalesce(F.col("a.ref_id"), F.lit(0)) == 0) & ((F.coalesce(F.col("b.ref_id"), F.lit(0)) != 0) | (F.coalesce(F.col("b.match_score"), F.lit(0.0)) > F.col("a.match_score")))
    columns = [c for c in first.columns if c != "paper_id"]
    joined = first.alias("a").join(second.alias("b"), "paper_id", "left")
    return joined.select("paper_id", *[F.when(missing, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in columns])
