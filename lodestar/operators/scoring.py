"""Remark scores of citation contexts, by a client that is passed in or by the dry-run stand-in."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

PROMPT_VERSION = "v1"
PAYLOAD = ("target_title", "reference_entry", "citation_marker", "citing_paper_title", "context")
PROMPT = (
    "Rate from 0 (very negative) to 10 (very positive) how the citing paper speaks of the cited one. "
    'Answer with a JSON object {"remark_score": integer, "reason": string}.\n'
)


def payload(target_title: Column, reference_entry: Column, marker: Column, citing_title: Column, context: Column) -> Column:
    """What the scorer is told: five strings, none null."""
    columns = (target_title, reference_entry, marker, citing_title, context)
    return F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(PAYLOAD, columns, strict=True)])


def parsed_reply(reply: Column) -> Column:
    """struct<remark_score, reason, error> of a reply: an object, or text around one. Booleans are no
    scores, an empty reason is a failure."""

    def judged(v: Column) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(v, "$.remark_score", "variant"))
        raw = F.try_variant_get(v, "$.remark_score", "string")
        score = tx.coerced_score(raw, kind == "BOOLEAN")
        reason = F.trim(F.try_variant_get(v, "$.reason", "string"))
        error = F.when(v.isNull(), "no_json").when(score.isNull(), "invalid_score").when(F.coalesce(reason, F.lit("")) == "", "empty_reason")
        return F.struct(F.when(error.isNull(), score).alias("remark_score"), F.when(error.isNull(), reason).alias("reason"), error.alias("error"))

    return tx.let(tx.lenient_json(reply), judged)


def within_budget(contexts: DataFrame, most: int | None, skip_scored: bool = True) -> Column:
    """Contexts to score: the first `most` by place, whether scored already or not, less the scored."""
    keep = F.lit(True) if most is None else F.col("ctx_pos") < most
    return keep & F.col("remark_score").isNull() if skip_scored else keep


def dry_run(contexts: DataFrame, most: int | None = None, skip_scored: bool = True) -> DataFrame:
    """Contexts with the stand-in score where one is due."""
    due = within_budget(contexts, most, skip_scored)
    return contexts.withColumns({
        "remark_score": F.when(due, tx.mock_score(F.col("target_title"), F.col("context"))).otherwise(F.col("remark_score")),
        "reason": F.when(due, F.lit("dry_run")).otherwise(F.col("reason")),
        "remark_error": F.when(~due, F.col("remark_error")),
    })


def scored_by(contexts: DataFrame, client: Callable[[str], str], most: int | None = None, skip_scored: bool = True, max_retries: int = 2) -> DataFrame:
    """Contexts scored by client(prompt) -> reply, in Arrow batches; each distinct payload is asked
    once. After 1 + max_retries failures the score is 5 with an error. The client must bear being
    asked again: Spark repeats tasks."""
    due = within_budget(contexts, most, skip_scored)
    told = payload(F.col("target_title"), F.col("reference_entry"), F.col("match_text"), F.col("citing_title"), F.col("context"))
    rows = contexts.withColumns({"__due": F.coalesce(due, F.lit(False)), "__p": F.to_json(told)})

    @F.pandas_udf(T.StringType())
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda p: asked(client, p, max_retries))

    answers = rows.where("__due").select("__p").distinct().withColumn("__r", F.from_json(ask("__p"), "remark_score int, reason string, error string"))
    joined = rows.join(answers, "__p", "left")
    pick = lambda new, old: F.when(F.col("__due"), F.col(f"__r.{new}")).otherwise(F.col(old))
    return joined.withColumns({"remark_score": pick("remark_score", "remark_score"), "reason": pick("reason", "reason"), "remark_error": pick("error", "remark_error")}).drop("__due", "__p", "__r")


def asked(client: Callable[[str], str], told: str, max_retries: int) -> str:
    """The client's judgement as JSON."""
    error = "no_reply"
    for _ in range(1 + max_retries):
        try:
            reply = client(PROMPT + told)
            start, end = reply.find("{"), reply.rfind("}")
            got = json.loads(reply[start : end + 1])
            score = got["remark_score"]
            if isinstance(score, bool):
                raise ValueError("invalid_score")
            reason = str(got.get("reason") or "").strip()
            if not reason:
                raise ValueError("empty_reason")
            return json.dumps({"remark_score": max(0, min(10, round(float(score)))), "reason": reason, "error": None})
        except Exception as e:  # noqa: BLE001  the failure becomes a column, not an exception
            error = str(e) or type(e).__name__
    return json.dumps({"remark_score": 5, "reason": None, "error": error})


def batch_metadata(contexts: DataFrame, model: str, dry: bool) -> DataFrame:
    """What a scoring run says of each paper."""
    return contexts.groupBy("paper_id").agg(F.count("*").alias("contexts_total"), F.count("remark_score").alias("contexts_scored"), F.count_if(F.col("remark_error").isNotNull()).alias("errors")).withColumns({"model": F.lit(model), "prompt_version": F.lit(PROMPT_VERSION), "dry_run": F.lit(dry)})
