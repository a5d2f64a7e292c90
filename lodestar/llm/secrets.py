"""Secret scan: candidates from patterns, judged by a random forest. Native expressions throughout.

A candidate is a run of 16 or more of [A-Za-z0-9_+/.-] with a digit or 20 capitals (and = at its end), or what is
assigned to a naming word (password, token, ...): 8 characters or more without blanks, quotes, commas
and semicolons, whatever they are. The forest looks at its length, at the transitions between
character classes and between letters, at how much of it dictionary words cover, at whether it looks
like a path, and at the words next to it. It removes false positives: digests, ids, paths, numbers,
placeholders, plain words.

The dictionary is the corpus's own: the WORDS most frequent words of all documents, of which letter
pairs are counted too. The forest is trained on labelled findings: a table of (hit, before, after,
label), by default `findings`, made from a rule, a seed and dictionary words.

Defined results: null and empty texts have no findings; repeated rows are scanned each; candidates do
not overlap, the leftmost stands, so starts have no ties; a probability of exactly the threshold is a
finding; other columns are ignored by scan and kept by redact, whatever they are called; texts of any
length are scanned whole; empty tables give no rows, and an empty dictionary covers nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spans import spans

#: Words that often name a secret, and words that name harmless digests and ids.
NAMING = "token|secret|passwd|password|passphrase|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|client[_-]?secret|signature"
#: One of these is in each naming word.
STEMS = ("token", "secret", "passw", "passphrase", "pwd", "api", "access", "private", "auth", "bearer", "credential", "signature")
HARMLESS = "commit|sha1|sha256|md5|checksum|digest|uuid|guid|revision|version|build|hash|etag|integrity|file|path|url|isbn|order|invoice|card|account"
RUN = r"(?<![A-Za-z0-9_+/.-])(?=[A-Za-z_+/.-]*+[0-9]|[A-Z]{20})[A-Za-z0-9_+/.-]{16,}+={0,2}+"
#: A naming word, what may close its quote, and an assignment.
NAMED = rf"(?i:{NAMING})[\"'\]]{{0,2}}\x20{{0,2}}(?:=>|:=|=|:)\x20{{0,2}}[\"'`]?"
VALUE = rf"(?<={NAMED})(?![\s\"'`=:>])[^\s\"'`,;]{{8,}}+"
AROUND = 40
THRESHOLD = 0.5
TREES, DEPTH = 40, 9
WORDS = 3000
MASK = "[SECRET]"


def dictionary(docs: DataFrame, words: int = WORDS) -> list[str]:
    """The most frequent words of 3 to 14 letters, lower-case, ties in order: at most `words`."""
    found = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"\p{L}++"), F.lit(0))).alias("w")).where(F.length("w").between(3, 14))
    return [r["w"] for r in found.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words).collect()]


@dataclass
class Judge:
    """A dictionary, and the forest that was fitted with it."""

    words: list[str]
    forest: PipelineModel


def features(row: dict[str, Column], words: list[str]) -> list[Column]:
    """Numbers that the forest sees, from hit, before and after."""
    hit, before, after = row["hit"], F.lower(row["before"]), F.lower(row["after"])
    n = F.length(hit).cast("double")
    count = lambda p: F.regexp_count(hit, F.lit(p)).cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(hit, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A"), "[^0aA]", "-")
    turns = n - F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    distinct = F.size(F.array_distinct(F.split(hit, ""))).cast("double")
    # runs of letters, with a border where case rises
    parts = F.transform(F.regexp_extract_all(hit, F.lit(r"\p{Lu}?\p{Ll}{2,}+|\p{Lu}{3,}+"), F.lit(0)), F.lower)
    # the dictionary is one literal, whatever its size: plans stay small
    listed = lambda book, w: F.contains(F.lit(f" {' '.join(book)} "), F.concat(F.lit(" "), w, F.lit(" ")))
    known = F.aggregate(F.filter(parts, lambda w: listed(words, w)), F.lit(0), lambda a, w: a + F.length(w))
    # letter pairs that dictionary words have: common ones only, so that chance pairs stay out
    seen: dict[str, int] = {}
    for w in words:
        for a, b in zip(w, w[1:], strict=False):
            seen[a + b] = seen.get(a + b, 0) + 1
    pairs = sorted(seen, key=lambda p: (-seen[p], p))[:120]
    low = F.lower(hit)
    own = F.transform(F.sequence(F.lit(1), F.greatest(F.length(hit) - 1, F.lit(1))), lambda i: F.substring(low, i, F.lit(2)))
    common_pairs = F.size(F.filter(own, lambda p: listed(pairs, p))).cast("double")
    return [
        n.alias("f_length"),
        (1 - turns / n).alias("f_turns"),
        (common_pairs / n).alias("f_pairs"),
        (distinct / F.least(n, F.lit(40.0))).alias("f_distinct"),
        (count("[0-9]") / n).alias("f_digits"),
        (count("[A-Z]") / n).alias("f_upper"),
        (count("[a-z]") / n).alias("f_lower"),
        (count("[^A-Za-z0-9]") / n).alias("f_marks"),
        (count("[g-zG-Z]") / n).alias("f_beyond_hex"),
        F.length(F.regexp_extract(hit, "[a-z]{4,}", 0)).cast("double").alias("f_longest_lower"),
        (known / n).alias("f_dictionary"),
        (count("/") + 2 * hit.rlike(r"\.[A-Za-z]{2,4}$").cast("int") + 2 * hit.rlike(r"^[./~]").cast("int")).cast("double").alias("f_path"),
        hit.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-").cast("double").alias("f_uuid"),
        hit.rlike(r"^(AKIA|ghp_|gho_|sk_|sk-|xox[abp]-|eyJ|AIza|glpat-)").cast("double").alias("f_prefix"),
        hit.rlike(r"(?i)(your|example|changeme|placeholder|xxxx|1234567|\$\{|<|\(\))").cast("double").alias("f_placeholder"),
        before.rlike(rf"({NAMING})[\s\"']*(=|:|is|:=|=>)?[\s\"'`]*$").cast("double").alias("f_named"),
        before.rlike(rf"({NAMING})").cast("double").alias("f_named_near"),
        before.rlike(rf"({HARMLESS})\S*[\s\"']*(=|:|is|no\.?|number)?[\s\"'`]*$").cast("double").alias("f_harmless"),
        before.rlike(r"(=|:|=>)\s*[\"'`]?$").cast("double").alias("f_assigned"),
        (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("double").alias("f_quoted"),
    ]


def findings(spark: SparkSession, words: list[str], rows: int = 12_000, seed: int = 11) -> DataFrame:
    """Labelled findings from a rule: half are random strings where secrets stand, passwords with marks
    and without digits among them; the others are digests, ids, numbers, paths, words and placeholders,
    some with a naming word before them."""
    r = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1_000_003))
    pick = lambda values, k: F.element_at(F.array(*[F.lit(v) for v in values]), (r(k) % len(values) + 1).cast("int"))
    some = (words[:: max(1, len(words) // 200)] or ["alpha", "beta", "gamma", "delta", "omega"])[:200]
    hexes = F.concat(F.sha2(F.concat("id", F.lit(f"a{seed}")), 256), F.sha2(F.concat("id", F.lit(f"b{seed}")), 256))
    base = F.regexp_replace(F.base64(F.unhex(hexes)), "[+/=\r\n]", "x")
    digits = F.regexp_replace(F.concat(r(1), r(2), r(3), r(4), r(5)).cast("string"), "^0", "4")
    word = F.concat(*[F.element_at(F.array(*[F.lit(v) for v in some]), (r(20 + i) % len(some) + 1).cast("int")) for i in range(4)])
    joined = F.concat_ws("_", *[F.element_at(F.array(*[F.lit(v) for v in some]), (r(30 + i) % len(some) + 1).cast("int")) for i in range(3)])
    letters = F.translate(F.left(hexes, F.lit(14)), "0123456789", "qwxzkvjypg")
    marked = F.concat(F.left(base, F.lit(5)), pick("!@#$%&*~?", 40), F.substring(base, 6, 4), pick("!@#$^&*~?", 41), F.substring(base, 10, 3))
    secrets = [F.left(hexes, F.lit(32)), F.left(hexes, F.lit(40)), F.left(hexes, F.lit(40)), F.left(hexes, F.lit(64)), F.left(base, F.lit(24)), F.left(base, F.lit(40)), F.concat(F.left(base, F.lit(43)), F.lit("=")), F.concat(F.lit("AKIA"), F.upper(F.left(base, F.lit(16)))), F.concat(F.lit("AKIA"), F.translate(F.upper(F.left(base, F.lit(16))), "0123456789", "QWXZKVJYPG")), F.concat(F.lit("ghp_"), F.left(base, F.lit(36))), F.concat(F.lit("sk_live_"), F.left(base, F.lit(24))), F.left(base, F.lit(12)), marked, marked, letters]
    secret = F.element_at(F.array(*secrets), (r(6) % len(secrets) + 1).cast("int"))
    uuid = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    path = F.concat(F.lit("/"), joined, F.lit("/"), (r(7) % 100).cast("string"), F.lit("/"), word, F.lit(".json"))
    one = lambda k: F.element_at(F.array(*[F.lit(v) for v in some]), (r(k) % len(some) + 1).cast("int"))
    host = F.concat(one(50), (r(51) % 30).cast("string"), F.lit("."), one(52), pick([".com", ".org", ".net", ".example.com", ".edu"], 53))
    page = F.concat(F.lit("www."), one(50), pick([".com/", ".org/", ".de/"], 53), one(54), F.lit("/"), (r(55) % 3000).cast("string"), F.lit("-"), one(56))
    file = F.concat(one(50), F.lit("_"), one(54), (2000 + r(55) % 30).cast("string"), pick([".pdf", ".tar.gz", ".html", ".png"], 53))
    moment = F.concat((2000 + r(55) % 30).cast("string"), F.lit("-0"), (1 + r(56) % 9).cast("string"), F.lit("-1"), (r(57) % 10).cast("string"), F.lit("T1"), (r(58) % 10).cast("string"), F.lit(".30.00"))
    others = [host, host, page, file, moment, F.left(hexes, F.lit(40)), F.left(hexes, F.lit(64)), uuid, F.left(digits, F.lit(16)), F.left(digits, F.lit(19)), path, F.concat(word, F.lit("."), (r(8) % 100).cast("string")), F.concat(joined, (r(8) % 1000).cast("string")), F.concat(F.lit("your_api_key_here_"), (r(8) % 10).cast("string")), F.concat(F.lit("example-0000-"), word), joined, word, F.upper(word), F.concat(F.lit("${"), joined, F.lit("}")), F.concat(joined, F.lit("()"))]
    other = F.element_at(F.array(*others), (r(9) % len(others) + 1).cast("int"))
    name = pick(["token", "secret", "password", "api_key", "access_key", "auth_token", "client_secret", "API-KEY", "passwd"], 10)
    bare = pick(["", "the ", "of ", "and, ", "en ", "der "], 11)
    joint = pick([' = "', ': "', "=", ": ", " = '", ' := "'], 12)
    quoted = F.when(joint.contains('"'), '"').when(joint.contains("'"), "'").otherwise("")
    harmless = pick(["commit ", "sha256: ", "checksum ", "uuid=", "build ", "order no. ", "file ", "digest: ", 'etag: "', "card "], 13)
    label = (F.col("id") % 2).cast("double")
    digest = other.rlike("^[0-9a-f]{40,64}$") | other.rlike("^[0-9a-f]{8}-")
    plain = ~other.rlike("[0-9]") | other.rlike("^(your|example)")
    short = F.length(secret) < 16
    prefixed = secret.rlike("^(AKIA|ghp_|sk_live_)") & (r(18) % 3 > 0)  # these tell without a name too
    before = F.when(label == 1, F.when(prefixed, bare).when((r(15) % 12 == 0) & ~short, F.concat(bare, joint)).otherwise(F.concat(bare, name, joint))).when(digest, harmless).when(plain, F.concat(name, joint)).when(other.rlike("^www") | (other == host), pick(["@", "https://", "at ", "", "from <"], 59)).when(r(16) % 3 == 0, harmless).otherwise(bare)
    after = F.concat(F.when((label == 1) | plain, quoted).otherwise(F.lit("")), pick([" ", " the", ".", ",", "\n"], 17))
    return spark.range(rows).select(F.when(label == 1, secret).otherwise(other).alias("hit"), before.alias("before"), after.alias("after"), label.alias("label"))


def fit(labelled: DataFrame, words: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> Judge:
    """The forest from labelled findings."""
    columns = features({c: F.col(c) for c in ("hit", "before", "after")}, words)
    rows = labelled.select(*columns, "label")
    names = [c for c in rows.columns if c.startswith("f_")]
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    # one partition and a fixed seed: the same findings give the same forest
    rows = assembler.transform(rows).select("features", "label").coalesce(1)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label").fit(rows)
    return Judge(words, PipelineModel([assembler, forest]))


def fitted(docs: DataFrame) -> Judge:
    """The forest for a corpus, from its own dictionary and findings made from a rule."""
    words = dictionary(docs)
    return fit(findings(docs.sparkSession, words), words)


def _names(text: Column) -> Column:
    """Whether a value may be assigned to a naming word: a plain search for parts of them first, as most
    texts have none."""
    low, some = F.lower(text), F.lit(False)
    for part in STEMS:
        some = some | F.contains(low, F.lit(part))
    return some & text.rlike(NAMED)


def candidates(text: Column) -> Column:
    """array<struct<start, hit, before, after>>; values are looked for only where something is assigned
    to a naming word."""
    none = F.array().cast("array<struct<start:bigint,hit:string,before:string,after:string>>")
    return F.when(_names(text), spans(text, f"{VALUE}|{RUN}", AROUND)).when(text.rlike(RUN), spans(text, RUN, AROUND)).otherwise(none)


def scan(docs: DataFrame, judge: Judge, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """Findings kept as secrets: key, start, end (code points), hit, probability."""
    found = docs.select(F.col(key).alias("__key"), F.explode(candidates(F.col("text").cast("string"))).alias("s"))
    return judged(found.select("__key", "s.*"), judge, threshold).select(F.col("__key").alias(key), "start", (F.col("start") + F.length("hit")).alias("end"), "hit", "probability")


def judged(found: DataFrame, judge: Judge, threshold: float) -> DataFrame:
    """Rows of (__key, start, hit, before, after) that the forest takes for secrets."""
    rows = found.select("__key", "start", "hit", *features({c: F.col(c) for c in ("hit", "before", "after")}, judge.words))
    scored = judge.forest.transform(rows).select("__key", "start", "hit", F.round(vector_to_array("probability")[1], 6).alias("probability"))
    return scored.where(F.col("probability") >= threshold)


def redact(docs: DataFrame, judge: Judge, threshold: float = THRESHOLD) -> DataFrame:
    """docs with MASK in place of each secret; n_chars follows where there is such a column.

    Only rows with a candidate leave the scan's path; findings come back to them by a hash of the
    whole text, so that ids may be null or repeat."""
    names = docs.columns
    keep = [f"__c{i}" for i in range(len(names))]
    rows = docs.toDF(*keep)
    text = F.col(keep[names.index("text")])
    has = F.coalesce(_names(text) | text.rlike(RUN), F.lit(False))
    key = F.sha2(text.cast("binary"), 256)
    hits = rows.where(has).select(key.alias("__k"), text.alias("text")).groupBy("__k").agg(F.first("text").alias("text"))
    found = scan(hits, judge, threshold, key="__k").groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__s"))
    joined = rows.where(has).withColumn("__k0", key).join(found, F.col("__k0") == F.col("__k"), "left")
    cut = F.aggregate("__s", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")), F.lit(MASK)).alias("out")), lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, F.length(text))))
    joined = joined.withColumn("__t", F.when(F.col("__s").isNull(), text).otherwise(cut))
    columns = [F.col(c) for c in keep]
    columns[names.index("text")] = F.col("__t").alias(keep[names.index("text")])
    if "n_chars" in names:
        k = names.index("n_chars")
        columns[k] = F.when(F.col("__s").isNull(), F.col(keep[k])).otherwise(F.length("__t")).cast(docs.schema["n_chars"].dataType).alias(keep[k])
    return rows.where(~has).unionByName(joined.select(columns)).toDF(*names)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret in `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scan(docs, fitted(docs))
