"""People in a knowledge graph: which entity an author is, and the awards it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Properties and classes of the graph.
INSTANCE_OF, EMPLOYER, AFFILIATION, AWARD, HUMAN = "P31", "P108", "P1416", "P166", "Q5"


def label_of(labels: Column, languages: tuple[str, ...] = ("en", "zh")) -> Column:
    """The label in the first language there is, else any."""
    return F.coalesce(*[F.try_element_at(labels, F.lit(x)) for x in languages], F.try_element_at(F.map_values(labels), F.lit(1)))


def claims_of(claims: Column, *properties: str) -> Column:
    return F.array_distinct(F.concat(*[F.coalesce(F.try_element_at(claims, F.lit(p)), F.array().cast("array<string>")) for p in properties]))


def is_human(claims: Column) -> Column:
    return F.array_contains(claims_of(claims, INSTANCE_OF), HUMAN)


def names_meet(a: Column, b: Column) -> Column:
    """Whether one of two names stands in the other."""
    x, y = tx.plain_norm(a), tx.plain_norm(b)
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def author_entities(hits: DataFrame, entities: DataFrame, labels: DataFrame) -> DataFrame:
    """(author_key, qid, matched): of the search hits (author_key, affiliation, rank, qid) the first
    human who works where the author does, else the first human, else the first hit. Organisations are
    met through the hit's own claims, so names are compared only within a hit."""
    known = hits.join(entities.select("qid", "claims"), "qid")
    places = known.select("author_key", "rank", "affiliation", F.explode(claims_of(F.col("claims"), EMPLOYER, AFFILIATION)).alias("org"))
    names = labels.select(F.col("qid").alias("org"), F.explode(F.concat(F.map_values("labels"), F.coalesce(F.flatten(F.map_values("aliases")), F.array().cast("array<string>")))).alias("org_name"))
    met = places.join(names, "org").where(names_meet(F.col("affiliation"), F.col("org_name"))).select("author_key", "rank", F.lit(True).alias("met")).distinct()
    rows = known.join(met, ["author_key", "rank"], "left").withColumn("level", F.when(is_human(F.col("claims")) & F.col("met"), 0).when(is_human(F.col("claims")), 1).otherwise(2))
    best = rows.withColumn("__n", F.row_number().over(Window.partitionBy("author_key").orderBy("level", "rank"))).where("__n = 1")
    return best.select("author_key", "qid", F.when(F.col("level") == 0, "affiliation").when(F.col("level") == 1, "human").otherwise("first_hit").alias("matched"))


def awards(people: DataFrame, entities: DataFrame, labels: DataFrame, keyword: str = "Fellow") -> DataFrame:
    """(author_key, award_qid, award, is_match) of each person's awards."""
    got = people.join(entities.select("qid", "claims"), "qid").select("author_key", F.posexplode(claims_of(F.col("claims"), AWARD)).alias("pos", "award_qid"))
    names = labels.select(F.col("qid").alias("award_qid"), label_of(F.col("labels")).alias("award"))
    return got.join(names, "award_qid", "left").withColumns({"award": F.coalesce("award", "award_qid")}).withColumn("is_match", F.contains(F.lower("award"), F.lit(keyword.lower()))).select("author_key", "pos", "award_qid", "award", "is_match")


def award_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("author_key").agg(F.count("*").alias("awards"), F.count_if("is_match").alias("matching"))
