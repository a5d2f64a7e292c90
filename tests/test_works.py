from pyspark.sql import functions as F

from lodestar.operators import works as W

AUTHOR = f"struct<author_id:string,name:string,orcid:string,author_position:string,is_corresponding:boolean,institutions:array<{W.INSTITUTION}>,h_index:int,affiliation:string>"
SCHEMA = f"paper_id string, paper_title string, year int, cited_by_count int, ord int, authors array<{AUTHOR}>"


def author(i, h=None, name=None, pos="middle", inst=None, aff=None):
    return (i, name or f"A {i}", None, pos, False, [(None, x, None, None) for x in inst or []], h, aff)


def works(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_arg_max_takes_the_first_of_equals(spark):
    df = works(spark, [("p", "t", 2020, 1, 0, [author("a", 5), author("b", 9), author("c", 9), author("d")]), ("q", "t", 2020, 1, 1, []), ("r", "t", 2020, 1, 2, [author("a"), author("b")])])
    got = {r["paper_id"]: r for r in df.select("paper_id", W.max_h_index_author(F.col("authors")).alias("m"), W.max_h_index(F.col("authors")).alias("h")).collect()}
    assert got["p"]["m"]["author_id"] == "b" and got["p"]["h"] == 9
    assert got["q"]["m"] is None and got["q"]["h"] is None
    assert got["r"]["m"]["author_id"] == "a" and got["r"]["m"]["h_index"] == 0 and got["r"]["h"] is None


def test_merge_keeps_first_row_unions_sources_and_spares_null_ids(spark):
    a = works(spark, [("p", "first", 2020, 1, 0, []), (None, "x", 1, 1, 1, [])])
    b = works(spark, [("p", "second", 2021, 2, 0, []), ("q", "only", 2022, 3, 1, []), (None, "x", 1, 1, 2, [])])
    rows = W.merged_recalls(("top_cited", a), ("recent_year", b)).orderBy("ord").collect()
    assert [(r["paper_id"], r["paper_title"], r["recall_sources"]) for r in rows] == [("p", "first", ["top_cited", "recent_year"]), (None, "x", ["top_cited"]), ("q", "only", ["recent_year"]), (None, "x", ["recent_year"])]


def test_enrichment_overwrites_only_known_and_fills_blank_affiliations(spark):
    df = works(spark, [("p", "t", 1, 1, 0, [author("https://x.org/a", 3, inst=["Uni"]), author("b", 4, inst=["Lab"]), author(None, 7)]), ("q", "t", 1, 1, 1, [])])
    m = spark.createDataFrame([("a", 50), ("c", 1)], "author_id string, h_index int")
    got = {r["paper_id"]: r["authors"] for r in W.enriched(df, m).collect()}
    assert [(a["h_index"], a["affiliation"]) for a in got["p"]] == [(50, "Uni"), (4, None), (7, None)] and got["q"] == []
    assert [a["h_index"] for a in {r["paper_id"]: r["authors"] for r in W.enriched(df, m, overwrite=True).collect()}["p"]] == [50, None, None]


def test_ignore_filter_normalises_names(spark):
    df = works(spark, [("p", "t", 1, 1, 0, [author("a", name="Li, J. X.")]), ("q", "t", 1, 1, 1, [author("b", name=None)])])
    kept, dropped = W.split_ignored(df, ["li j x"])
    assert [r["paper_id"] for r in kept.collect()] == ["q"]
    assert [(r["paper_id"], r["filter_reason"]) for r in dropped.collect()] == [("p", "ignored_author")]
    assert W.split_ignored(df, [" "])[0].count() == 2


def test_recent_cap_and_order(spark):
    rows = [(f"p{i}", "t", 2020, i, i, [author("a", h)]) for i, h in enumerate([1, 9, 5])]
    df = works(spark, rows).withColumn("recall_sources", F.when(F.col("ord") == 1, F.array(F.lit("top_cited"), F.lit("recent_year"))).otherwise(F.array(F.lit("recent_year"))))
    kept, dropped = W.split_recent_only(df, 1)
    assert sorted(r["paper_id"] for r in kept.collect()) == ["p1", "p2"] and [r["paper_id"] for r in dropped.collect()] == ["p0"]
    for off in (None, 0):
        assert W.split_recent_only(df, off)[0].count() == 3


def test_selection_prefers_fellows_over_rank(spark):
    df = works(spark, [(f"p{i}", "t", 2020, i, i, [author("a", i)]) for i in range(4)]).withColumn("max_h_index_author", W.max_h_index_author(F.col("authors")))
    some = W.selected(df.withColumn("has_fellow_topk", F.col("ord").isin(0, 2)), 1).orderBy("ord").collect()
    assert [(r["paper_id"], r["selection_reason"]) for r in some] == [("p0", "primary"), ("p2", "primary")]
    none = W.selected(df.withColumn("has_fellow_topk", F.lit(False)), 2).collect()
    assert sorted(r["paper_id"] for r in none) == ["p2", "p3"]


def test_self_citation_has_three_states(spark):
    df = works(spark, [("p", "t", 1, 1, 0, [author("a", name="Ann Lee")])])
    one = lambda name: df.select(W.self_citation(F.col("authors"), F.lit(name).cast("string"))).first()[0]
    assert (one("ann, lee"), one("bob"), one(" "), one(None)) == (True, False, None, None)


def test_raw_works_and_authors(spark):
    raw = spark.read.json(spark.sparkContext.parallelize(['{"id":"https://o.org/W1","openalex_id":null,"display_name":null,"title":"T","doi":null,"ids":{"doi":"10.1"},"publication_year":2020,"cited_by_count":3,"venue":"V","primary_location":{"source":{"display_name":" ","name":"N"}},"host_venue":{"display_name":null,"name":null},"authorships":[{"author_position":"first","is_corresponding":true,"author":{"id":"https://o.org/A1/","display_name":"Ann","orcid":null,"ids":{"orcid":"o"}},"institutions":[{"id":"https://o.org/I1","display_name":"Uni","ror":null,"country_code":"DE"},{"id":null,"display_name":" ","ror":null,"country_code":null}]}],"abstract_inverted_index":null}']))
    from pyspark.sql import types as T

    raw = raw.withColumn("abstract_inverted_index", F.lit(None).cast(T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))))
    r = W.normalized_works(raw).first()
    assert (r["paper_id"], r["paper_title"], r["paper_doi"], r["venue"]) == ("W1", "T", "10.1", "N")
    assert r["authors"][0]["author_id"] == "A1" and r["authors"][0]["orcid"] == "o" and [i["id"] for i in r["authors"][0]["institutions"]] == ["I1"]
    a = spark.read.json(spark.sparkContext.parallelize(['{"id":"A1","openalex_id":null,"display_name":"Ann","orcid":null,"ids":{"orcid":null},"summary_stats":{"h_index":0},"h_index":7,"works_count":1,"cited_by_count":2,"affiliations":[{"institution":{"display_name":" ","name":null}},{"institution":{"display_name":null,"name":"Lab"}}]}']))
    b = W.normalized_authors(a).first()
    assert (b["h_index"], b["affiliation"]) == (7, "Lab")
