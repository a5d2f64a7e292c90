import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.functions import charsets, similarity, web
from lodestar.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("  A  B-c! ", "a bc"), ("É É", "é é"), ("", ""), ("x_y (z)", "x_y z")])
def test_title_norm(spark, raw, want):
    assert one(spark, tx.title_norm(F.lit(raw))) == want


@pytest.mark.parametrize(("raw", "want"), [("https://o.org/W12/", "W12"), (" W3 ", "W3"), ("http://a/b/c", "c")])
def test_short_id(spark, raw, want):
    assert one(spark, tx.short_id(F.lit(raw))) == want


def test_scores_round_half_to_even_and_clip(spark):
    rows = spark.createDataFrame([("2.5",), ("3.5",), ("11",), ("-1",), ("x",), (None,), (" 7 ",)], "r string").select(tx.coerced_score(F.col("r")).alias("s"))
    assert [r["s"] for r in rows.collect()] == [2, 4, 10, 0, None, None, 7]


def test_inverted_index(spark):
    assert one(spark, tx.inverted_index_text(F.create_map(F.lit("b"), F.array(F.lit(1), F.lit(3)), F.lit("a"), F.array(F.lit(0), F.lit(2))))) == "a b a b"


def test_lines_and_columns(spark):
    text = "ab\ncd\r\ne𝑥f"
    for at, want in ((0, (1, 1)), (3, (2, 1)), (7, (3, 1)), (9, (3, 3))):
        assert (one(spark, tx.line_of(F.lit(text), F.lit(at))), one(spark, tx.column_of(F.lit(text), F.lit(at)))) == want


def test_spans_count_code_points(spark):
    assert [(s["start"], s["end"], s["hit"]) for s in one(spark, tx.spans(F.lit("𝑥[4] é[12]"), r"\[\d+\]"))] == [(1, 4, "[4]"), (6, 10, "[12]")]


def test_lenient_json(spark):
    get = lambda s: one(spark, F.try_variant_get(tx.lenient_json(F.lit(s)), "$.a", "string"))
    assert (get('{"a": 1}'), get('so {"a": "x"} there'), get("{bad"), get("none")) == ("1", "x", None, None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abc É\n.,", max_size=12), min_size=1, max_size=8))
def test_squeeze_like_python(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.squeezed(F.col("t")).alias("s")).collect()
    assert [r["s"] for r in rows] == [" ".join(t.split()) for t in texts]


def test_urls(spark):
    u = lambda s: F.lit(s)
    assert one(spark, web.unwrapped(u("https://duckduckgo.com/l/?uddg=https%3A%2F%2Fa.b%2Fc&x=1"))) == "https://a.b/c"
    assert one(spark, web.arxiv_pdf(u("https://arxiv.org/abs/2101.1/"))) == "https://arxiv.org/pdf/2101.1.pdf"
    assert one(spark, web.arxiv_pdf(u("https://a.org/abs/2101.1"))) is None
    assert one(spark, web.is_pdf_like(u("https://a.b/x?format=pdf"))) and not one(spark, web.is_pdf_like(u("not a url")))
    assert one(spark, web.admission(u("https://en.wikipedia.org/wiki/X"), False)) == "wikipedia_disabled"
    assert one(spark, web.admission(u("https://x.edu/?r=acm.org"), True)) == "blocked_domain_or_pdf"
    assert one(spark, web.candidate_score(u("https://cs.x.edu/people/lee"), F.lit("Ann Lee, Professor"), tx.name_tokens(F.lit("Ann Lee")))) == 20 + 12 + 8 + 8 + 8


def test_page_texts(spark):
    html = "<html><body><nav>menu</nav><article><h1>Ann</h1><p>IEEE  Fellow<script>x</script></p></article><p>out</p></body></html>"
    assert web.body_text_of(html) == "Ann\nIEEE Fellow" and web.body_text_of(None) == ""
    text = "x" * 2000 + "biography" + "y" * 6000
    assert len(one(spark, web.keyword_windows(F.lit(text), ("biography",)))) == 1200 + 2600
    assert one(spark, web.keyword_windows(F.lit("plain"), ("biography",))) == ""


def test_ratio_is_difflibs(spark):
    from difflib import SequenceMatcher

    a, b = "abcd efgh", "abxd  efgh" * 30
    assert one(spark, similarity.ratio(F.lit(a), F.lit(b))) == SequenceMatcher(None, a, b).ratio()
    rows = spark.createDataFrame([("ﬁne Title.",), ("Plain Title. ",), (None,)], "t string")
    assert sorted(r["n"] for r in similarity.with_bibliography_norm(rows, "t", "n").collect()) == ["", "fine title", "plain title"]


def test_charsets():
    assert charsets.repaired_text("ZÃ¼rich UniversitÃ¤t MÃ¼nchen") == "Zürich Universität München"
    assert charsets.repaired_text("plain") == "plain" and charsets.repaired_text(None) == ""
    assert charsets.decoded("清华大学计算机系教授".encode("gb18030"))[1] == "gb18030"
    assert charsets.decoded(b'<meta charset="windows-1252">caf\xe9', None)[0].endswith("café")
    assert charsets.charset_name("GB2312") == "gb18030"


def test_median_agrees(spark):
    assert one(spark, F.median(F.lit(3))) == statistics.median([3])
