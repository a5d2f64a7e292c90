"""Personal data by base patterns and by bootstrapped contextual extraction. Native throughout.

Base patterns find emails, IP addresses, payment cards and phone numbers, leftmost first. Their
instances are the seeds, believed from the start. Candidates are strings that have the looser shape of
a kind, in writings that the base patterns don't take, apart from base spans.

A graph joins each instance (seed or candidate) to the lexical patterns that it occurs with: the words
to its left, to its right, or both. Round by round
- a pattern scores, for a kind, the believed instances of the kind among all that it occurs with.
  Instances of other kinds speak against it, undecided ones of the right shape a quarter as much, and
  few believed ones are discounted;
- patterns of SUPPORT believed instances or more and a score of PATTERN or more make the instances
  that occur with them believed, as much as all such patterns together say;
- what is believed (BELIEF) induces patterns in the next round, until nothing new is believed.
Every occurrence of a believed candidate is a span.

Defined results: null texts count as empty and have no spans; repeated rows are searched each; other
columns are ignored, whatever they are called; texts of any length are searched whole; spans that
overlap one found before them (base spans first, then by start, kind and end) are dropped; equal
scores need no order, as thresholds alone decide; an empty table gives no rows; without seeds nothing
is discovered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .spans import spans

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that a start that must fail is not tried again from the next character.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text may have the kind at all.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.", "card": r"[0-9](?:[\x20-]?+[0-9]){15}", "phone": r"\+[0-9]"}
#: Writings of candidates, written so that a start that must fail is not tried again, with a cheap test.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.-])(?:[0-9]{1,3}(?:[.-][0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Za-z:.-]*[0-9A-Za-z:])",
    "number": r"(?<![0-9A-Za-z(+.,-])[(+]?[0-9](?:[\x20().-]{0,2}+[0-9])++(?![0-9A-Za-z])",
}
LOOSE_HINTS = {"email": r"@|[(\[](?:at|AT)[)\]]", "ip": r"[0-9][.-][0-9]{1,3}[.-][0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:", "number": r"[0-9](?:[\x20().-]{0,2}+[0-9]){6}"}
#: Digits that a number of the kind has.
DIGITS = {"card": (12, 19), "phone": (7, 15)}
AROUND = 48
SUPPORT, PATTERN, BELIEF, ROUNDS = 5, 0.75, 0.75, 8
#: What an undecided instance of the right shape counts against a pattern.
DOUBT = 0.25


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    """What a base match must pass."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return hit.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, k, start, end, hit, before, after>> in order of kind, then start."""
    none = F.array().cast("array<struct<kind:string,k:int,start:bigint,end:bigint,hit:string,before:string,after:string>>")
    parts = [F.when(text.rlike(HINTS[kind]), _of_kind(text, k, kind)).otherwise(none) for k, kind in enumerate(KINDS)]
    return F.concat(*parts)


def _of_kind(text: Column, k: int, kind: str) -> Column:
    found = F.filter(spans(text, PATTERNS[kind], AROUND), lambda s: valid(kind, s["hit"]))
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("k"), s["start"].alias("start"), (s["start"] + F.length(s["hit"])).alias("end"), s["hit"].alias("hit"), s["before"].alias("before"), s["after"].alias("after")))


def written_spans(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _loose_of(text: Column, form: str, pattern: str) -> Column:
    def kinds(hit: Column) -> Column:
        if form != "number":
            return F.array(F.lit(form))
        digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
        return F.filter(F.array(*[F.when(digits.between(*DIGITS[k]), F.lit(k)) for k in DIGITS]), lambda k: k.isNotNull())

    return F.transform(spans(text, pattern, AROUND), lambda s: F.struct(kinds(s["hit"]).alias("kinds"), s["start"].alias("start"), (s["start"] + F.length(s["hit"])).alias("end"), s["hit"].alias("hit"), s["before"].alias("before"), s["after"].alias("after")))


def loose_spans(text: Column, base: Column) -> Column:
    """array<struct<kinds, start, end, hit, before, after>> of candidates apart from base spans."""
    none = F.array().cast("array<struct<kinds:array<string>,start:bigint,end:bigint,hit:string,before:string,after:string>>")
    parts = []
    for form, pattern in LOOSE.items():
        apart = F.filter(_loose_of(text, form, pattern), lambda s: (F.size(s["kinds"]) > 0) & ~F.exists(base, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))
        parts.append(F.when(text.rlike(LOOSE_HINTS[form]), apart).otherwise(none))
    return F.concat(*parts)


def _word(side: Column, last: bool) -> Column:
    """The nearest word of a context, lower-case, digits as 0; empty where there is none."""
    got = F.regexp_extract(side, r"(\S+)\s*$" if last else r"^\s*(\S+)", 1)
    return F.regexp_replace(F.lower(got), "[0-9]+", "0")


def _patterns(before: Column, after: Column) -> Column:
    left, right = _word(before, True), _word(after, False)
    none = F.lit(None).cast("string")
    return F.filter(F.array(F.when(left != "", F.concat(F.lit("L "), left)).otherwise(none), F.when(right != "", F.concat(F.lit("R "), right)).otherwise(none), F.when((left != "") & (right != ""), F.concat(F.lit("B "), left, F.lit(" "), right)).otherwise(none)), lambda p: p.isNotNull())


def _graph(base: DataFrame, candidates: DataFrame, support: int) -> DataFrame:
    """kind, instance, pattern, seed, everything (instances of any kind that the pattern occurs with),
    c (rows of the pattern). Patterns that too few instances of a kind occur with can't come to score."""
    seeds = base.select("kind", F.lower("hit").alias("instance"), F.lit(True).alias("seed"), F.explode(_patterns(F.col("before"), F.col("after"))).alias("pattern"))
    others = candidates.select(F.lower("hit").alias("instance"), "kinds", F.explode(_patterns(F.col("before"), F.col("after"))).alias("pattern"))
    others = others.select(F.explode("kinds").alias("kind"), "instance", F.lit(False).alias("seed"), "pattern")
    rows = common.written(seeds.unionByName(others).groupBy("kind", "instance", "pattern").agg(F.bool_or("seed").alias("seed")), "occurs")
    several = rows.groupBy("kind", "pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support).select("pattern").distinct()
    # distinct instances of a pattern: those that are of two kinds count once
    once = rows.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count("*").alias("everything"))
    counts = rows.groupBy("pattern").agg(F.count("*").alias("c")).join(several, "pattern").join(once, "pattern")
    return common.written(common.counted_join(rows, common.written(counts, "patterns"), ["pattern"], "c"), "graph")


def bootstrap(base: DataFrame, candidates: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, least: float = PATTERN, belief: float = BELIEF) -> tuple[DataFrame, DataFrame]:
    """(kind, instance, round) of the candidates that come to be believed, and (kind, pattern, score)
    of the patterns at the end.

    base: seed occurrences (kind, hit, before, after); candidates: occurrences (kinds, hit, before, after)."""
    graph = _graph(base, candidates, support)
    total = graph.count()
    told = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))
    state = graph.withColumn("belief", F.lit(0.0))
    known, found, scored = 0, None, None
    for r in range(rounds):
        sure = told >= belief
        yes, unsure = F.sum(F.when(sure, told).otherwise(0.0)), F.count_if(~sure)
        n_yes = F.count_if(sure)
        against = F.first("everything") - n_yes - unsure + DOUBT * unsure
        scored = state.groupBy("kind", "pattern").agg((yes / (n_yes + against) * (1 - 1 / (1 + yes))).alias("score"), n_yes.alias("n"), F.first("c").alias("c"))
        scored = common.written(scored.where((F.col("n") >= support) & (F.col("score") >= least)), "scores")
        met = common.counted_join(graph.where(~F.col("seed")), scored.select("kind", "pattern", "score", "c"), ["pattern", "kind"], "c", total)
        met = met.groupBy("kind", "instance").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("belief")).where(F.col("belief") >= belief)
        now = common.written(met, "believed")
        fresh = now.select("kind", "instance", F.lit(r + 1).alias("round"))
        found = fresh if found is None else common.written(found.unionByName(fresh).groupBy("kind", "instance").agg(F.min("round").alias("round")), "found")
        n = found.count()
        if n == known or r == rounds - 1:
            break
        known = n
        # what has been believed once stays so
        beliefs = found.select("kind", "instance", F.lit(1.0).alias("belief"))
        state = common.written(graph.join(beliefs.hint("merge"), ["kind", "instance"], "left"), "state")
    return found.join(base.select("kind", F.lower("hit").alias("instance")).distinct(), ["kind", "instance"], "left_anti"), scored.select("kind", "pattern", "score")


def personal_data(docs: DataFrame, support: int = SUPPORT, least: float = PATTERN, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and found (arrays of spans: kind, k, start, end, hit) for each row of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # what a text has is written without the text; the row's place among equal ids is not needed
    found = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base")).select("doc_id", "base", loose_spans(F.col("text"), F.col("base")).alias("seen"))
    # a row is known by its spans: rows with equal ones get equal answers
    found = common.written(found.withColumn("key", F.xxhash64("doc_id", F.to_json("seen"), F.to_json("base"))), "found")
    base = found.select(F.explode("base").alias("s")).select("s.kind", "s.hit", "s.before", "s.after")
    candidates = found.select(F.explode("seen").alias("s")).select("s.kinds", "s.hit", "s.before", "s.after")
    believed, _ = bootstrap(base, candidates, rounds=rounds, support=support, least=least)
    hits = found.select("key", F.explode("seen").alias("s")).select("key", "s.start", "s.end", "s.hit", F.lower("s.hit").alias("instance"), F.explode("s.kinds").alias("kind"))
    counts = hits.groupBy("kind", "instance").agg(F.count("*").alias("c"))
    new = common.counted_join(hits, common.written(believed.join(counts, ["kind", "instance"]).select("kind", "instance", "c"), "believed"), ["kind", "instance"], "c")
    new = common.written(new.select("key", "kind", "start", "end", "hit").groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end", "hit"))).alias("new")), "discovered")
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit")))
    place = lambda kind: (F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int") - 1)
    kept = F.aggregate(
        F.coalesce("new", F.array().cast(new.schema["new"].dataType)),
        plain,
        lambda acc, x: F.when(F.exists(acc, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])), acc).otherwise(F.concat(acc, F.array(F.struct(x["kind"].alias("kind"), place(x["kind"]).alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"))))),
    )
    by_kind = F.array_sort(F.transform(kept, lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["hit"].alias("hit"))))
    ordered = F.transform(by_kind, lambda s: F.struct(s["kind"].alias("kind"), s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit")))
    some = F.size("seen") > 0
    joined = found.where(some).drop("seen").join(new, "key", "left").select("doc_id", plain.alias("base"), F.when(F.col("new").isNull(), plain).otherwise(ordered).alias("found"))
    # rows without candidates can't get new spans: they are not shuffled
    return joined.unionByName(found.where(~some).select("doc_id", plain.alias("base"), plain.alias("found")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of personal data in every text of `documents`."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"), written_spans(F.col("found")).alias("spans"), F.size("found").cast("long").alias("n_spans"))
