import pytest
from pyspark.sql import functions as F

from lodestar.operators import references as R


def parse(spark, text):
    r = R.with_entries(spark.createDataFrame([("p", text)], "paper_id string, references string")).first()
    return r["parse_method"], [(e["ref_id"], e["raw_text"]) for e in r["entries"]]


@pytest.mark.parametrize(
    ("text", "method", "n"),
    [
        ("\n[1] Aa. T. 2001.\n[2] Bb. U. [3] Cc. V.", "numeric", 3),
        ("\n1. Aa. T. 2001. 2. Bb. U.\n3) Cc", "numeric_list", 3),
        ("\nAaaa Bbbb. A long title here. 2001.\n\nCccc Dddd. Another title there.", "blank_lines", 2),
        ("\nshort\n\nAaaa Bbbb. A long title here. 2001.\n\nCccc Dddd. Another title there.", "blank_lines", 2),
        ("Aaaa title 2001\nBbbb title 2002\n  continued", "year_anchors", 2),
        ("- one thing\n- other thing", "list_items", 2),
        ("just text", "single_entry", 1),
        ("  \n ", "empty", 0),
    ],
)
def test_cascade(spark, text, method, n):
    got = parse(spark, text)
    assert got[0] == method and len(got[1]) == n, got


def test_split_at_last_heading(spark):
    for text, want in (("a\n## References\nb\n**Bibliography**\nc", ("a\n## References\nb", "\nc")), ("x\nreferences and notes \ny", ("x", "\ny")), ("no References here", None)):
        s = spark.range(1).select(R.split_text(F.lit(text)).alias("s")).first()["s"]
        assert (s and (s["body"].rstrip("\n"), s["references"])) == want


def test_numeric_ranges_both_ways(spark):
    body = "a [4] b [1–3, 9] c [8-5] d [x] e [2;7]"
    for ref, want in ((2, ["[1–3, 9]", "[2;7]"]), (6, ["[8-5]"]), (4, ["[4]"]), (10, [])):
        cs = spark.range(1).select(R.numeric_contexts(F.lit(body), F.lit(ref), 3).alias("c")).first()["c"]
        assert [c["match_text"] for c in cs] == want
        assert all(body[c["start"] : c["end"]] == c["match_text"] and c["context"] == body[max(0, c["start"] - 3) : c["end"] + 3] for c in cs)


def test_author_year_end_to_end(spark):
    text = "As Wu et al. (2021a) say. Others (see Wu et al., 2021a; Li, 2020) agree, Wu (2019a, b) too.\n\nReferences\n\nWu, X. Parsing citations at scale. 2021a.\n\nLi, Y. Another great title here. 2020.\n"
    df = spark.createDataFrame([("p", text, "Parsing citations at scale"), ("n", "no heading", "x"), ("e", "t\nReferences\n", "x")], "paper_id string, text string, title string")
    got = {r["paper_id"]: r for r in R.reference_contexts(df, 10, 0.6).collect()}
    assert got["p"]["author_year_key"] == "Wu|2021a" and got["p"]["citation_style"] == "author_year"
    assert [c["match_text"] for c in got["p"]["contexts"]] == ["(see Wu et al., 2021a; Li, 2020)", "Wu et al. (2021a)"]
    assert got["n"]["error"] == R.NO_HEADING and got["e"]["errors"] == ["no_reference_entries"]


def test_entry_match_prefers_first_and_uses_recall(spark):
    e = spark.createDataFrame([("p", 0, 1, "deep nets for graphs"), ("p", 1, 2, "Deep  nets, for Graphs!")], "paper_id string, entry_pos int, ref_id int, raw_text string")
    t = spark.createDataFrame([("p", "Deep Nets for Graphs")], "paper_id string, title string")
    r = R.matched_entries(e, t).first()
    assert (r["ref_id"], r["score"]) == (1, 1.0)
    weak = spark.createDataFrame([("p", "Something else entirely")], "paper_id string, title string")
    assert R.matched_entries(e, weak).count() == 0


def test_entry_fields(spark):
    df = spark.createDataFrame([("p", [(1, "- [3] O'Neil, A. Title. (1999b)"), (2, "2) lower 2001"), (3, "Zed no year")])], "paper_id string, entries array<struct<ref_id:int,raw_text:string>>")
    rows = R.entry_table(df).orderBy("entry_pos").collect()
    assert [(r["first_author"], r["year"], r["year_suffix"], r["author_year_key"]) for r in rows] == [("O'Neil", "1999", "b", "o'neil|1999b"), (None, "2001", None, None), ("Zed", None, None, None)]
