"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to character
n-grams, the longest length at which any of its n-grams is known, down to single characters. A
document's score is the posterior of the sums over its words.

The model is fitted on a bounded sample of labelled rows: ROWS_A_LANGUAGE rows of each language in
expectation, chosen by a hash of the id, their whole texts; it has the WORDS most frequent words and
the GRAMS most frequent n-grams of each language, and of each of them only the languages that use it.
That bounds what is broadcast by the number of languages, whatever the corpus.

Defined results: null texts and texts without letters are `und` with score 0, and so is every text
where no row is labelled or the tables are empty; repeated rows are scored each; ties go to the
language first in order; other columns are ignored, whatever they are called; texts and words of any
length are read whole; numerals are not letters.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

ROWS_A_LANGUAGE = 3000
WORDS = 20_000
GRAMS = 20_000
LONGEST_GRAM = 5
#: A longer run of letters is rather a text without blanks: its n-grams count, it is no word.
LONGEST_WORD = 64
#: A table of so many numbers (4 bytes each) at most is held as a matrix; a larger one row by row.
DENSE = 8_000_000
#: Numbers of the tokens' scores that a worker keeps (4 bytes each).
KEPT = 2_000_000
UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")
#: ASCII that is no letter.
MARKS = "".join(c for c in map(chr, range(128)) if not c.isalpha())


def fit(labelled: DataFrame, rows: int = ROWS_A_LANGUAGE, words: int = WORDS, grams: int = GRAMS) -> dict:
    """The model from rows of (doc_id, text, lang)."""
    named = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    model: dict = {"langs": langs, "words": _table({}, langs, {}), "grams": _table({}, langs, {})}
    if not langs:
        return model
    spot = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    kept = F.lit(False)
    for lang, n in sizes.items():
        kept = kept | ((F.col("lang") == lang) & (spot < int(min(1.0, rows / n) * (1 << 20)) + (n <= rows)))
    tokens = named.where(kept).select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    counts = common.written(tokens.groupBy("lang", "w").agg(F.count("*").alias("c")), "langid")
    top = Window.partitionBy("lang", "k").orderBy(F.desc("c"), "w")
    whole = counts.where(F.length("w") <= LONGEST_WORD).withColumn("k", F.lit(0))
    # n-grams of the whole word, however long: it is cut into parts, each with the letters of the next
    # that its last n-grams need
    parts = F.split(F.concat(F.lit("_"), F.col("w"), F.lit("_")), r"(?<=\G.{%d})" % LONGEST_WORD)
    piece = F.transform(parts, lambda x, i: F.struct(F.length(x).alias("own"), F.concat(x, F.coalesce(F.left(F.get(parts, i + 1), F.lit(LONGEST_GRAM - 1)), F.lit(""))).alias("w")))
    pieces = counts.select("lang", "c", F.explode(piece).alias("p")).select("lang", "c", "p.*", F.explode(F.array(*[F.lit(k) for k in range(1, LONGEST_GRAM + 1)])).alias("k"))
    starts = F.least(F.col("own"), F.length("w") - F.col("k") + 1)
    cut = F.transform(F.sequence(F.lit(1), starts), lambda i: F.substring(F.col("w"), i, F.col("k")))
    grams_ = pieces.where(starts > 0).select("lang", "k", "c", F.explode(cut).alias("w")).groupBy("lang", "w", "k").agg(F.sum("c").alias("c"))
    both = common.written(whole.select("lang", "k", "w", "c").unionByName(grams_.select("lang", "k", "w", "c")), "langid")
    share = F.when(F.col("k") == 0, F.lit(words)).otherwise(F.lit(grams // LONGEST_GRAM))
    found = both.withColumn("r", F.row_number().over(top)).where(F.col("r") <= share).select("lang", "k", "w", "c").toArrow()
    totals = {(r["lang"], r["k"]): r["n"] for r in both.groupBy("lang", "k").agg(F.sum("c").alias("n")).collect()}
    at = {x: i for i, x in enumerate(langs)}
    tables: dict[bool, dict[str, dict[int, int]]] = {False: {}, True: {}}
    for lang, k, w, c in zip(*(found.column(i).to_pylist() for i in range(4)), strict=True):
        tables[k > 0].setdefault(w, {})[at[lang]] = c
    model["words"] = _table(tables[False], langs, totals, level=0)
    model["grams"] = _table(tables[True], langs, totals)  # an n-gram's length is its level
    return model


def _table(seen: dict[str, dict[int, int]], langs: list[str], totals: dict[tuple[str, int], int], level: int | None = None) -> dict:
    """Log frequencies of strings: for each string where its numbers begin, and there the languages
    that use it with what it adds to an unseen string's frequency of its level."""
    none = {k: np.array([np.log(0.1 / (totals.get((lang, k), 0) + 1000.0)) for lang in langs], np.float32) for k in range(LONGEST_GRAM + 1)}
    names = sorted(seen)
    ends = np.cumsum([0, *[len(seen[w]) for w in names]]).astype(np.int64)
    used = np.array([i for w in names for i in sorted(seen[w])], np.int32)
    more = np.array([np.log((seen[w][i] + 0.1) / 0.1) for w in names for i in sorted(seen[w])], np.float32)
    table = {"at": {w: i for i, w in enumerate(names)}, "ends": ends, "langs": used, "more": more, "none": none, "level": level, "dense": None}
    if len(names) * len(langs) <= DENSE:
        table["dense"] = np.array([_row(table, i, w) for i, w in enumerate(names)], np.float32).reshape(len(names), len(langs))
    return table


def _row(table: dict, i: int, name: str) -> np.ndarray:
    """The log frequencies of the i-th string."""
    if table["dense"] is not None:
        return table["dense"][i]
    a, b = table["ends"][i], table["ends"][i + 1]
    out = table["none"][len(name) if table["level"] is None else table["level"]].copy()
    out[table["langs"][a:b]] += table["more"][a:b]
    return out


class Scorer:
    """Scores texts; what it has worked out for a blank-separated token it keeps for the next."""

    def __init__(self, model: dict):
        self.m = model
        self.n = len(model["langs"])
        self.kept = max(1 << 14, KEPT // (self.n + 1))
        self._reset()

    def _reset(self) -> None:
        self.rows = np.zeros((1 << 14, self.n + 1), np.float32)
        self.at: dict[str, int] = {}

    def word(self, word: str) -> np.ndarray:
        """Log scores of one lower-case word."""
        words, grams = self.m["words"], self.m["grams"]
        if (i := words["at"].get(word)) is not None:
            return _row(words, i, word)
        padded, at = f"_{word}_", grams["at"]
        for k in range(min(LONGEST_GRAM, len(padded)), 0, -1):
            known = [(i, g) for j in range(len(padded) - k + 1) if (i := at.get(g := padded[j : j + k])) is not None]
            if known:
                rows = grams["dense"][[i for i, _ in known]] if grams["dense"] is not None else np.array([_row(grams, i, g) for i, g in known])
                return rows.mean(axis=0)
        return np.zeros(self.n, np.float32)

    def token(self, token: str) -> np.ndarray:
        """Sums over the words in a token, then how many they are."""
        out = np.zeros(self.n + 1, np.float32)
        low = token.lower()
        bare = low.strip(MARKS)  # most tokens are one word, with marks around it
        for w in [bare] if bare.isalpha() else LETTERS.findall(low):
            out[:-1] += self.word(w)
            out[-1] += 1
        return out

    def sums(self, texts: list[str]) -> np.ndarray:
        """A row for each text: sums of log scores, words."""
        split = [t.split() for t in texts]
        if len(self.at) > self.kept:
            self._reset()
        out = np.zeros((len(texts), self.n + 1), np.float64)
        for i, tokens in enumerate(split):
            long = [t for t in tokens if len(t) > 48]
            if long:
                tokens = [t for t in tokens if len(t) <= 48]
                for t in long:
                    out[i] += self.token(t)
            for start in range(0, len(tokens), 1 << 16):
                part = tokens[start : start + (1 << 16)]
                at = self.at
                for t in set(part).difference(at):
                    if len(at) == len(self.rows):
                        self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.rows[len(at)] = self.token(t)
                    at[t] = len(at)
                out[i] += self.rows[np.fromiter(map(at.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=np.float64)
                if len(at) > 2 * self.kept:
                    self._reset()
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for row in self.sums(texts):
            if not self.n or not row[-1]:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            e = np.exp(row[:-1] - row[:-1].max())
            k = int(e.argmax())
            langs.append(self.m["langs"][k])
            scores.append(float(e[k] / e.sum()))
        return langs, scores


_scorers: dict[str, Scorer] = {}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score of every row of (doc_id, text)."""
    schema = "doc_id long, lang_pred string, score double"
    out_schema = common.fields(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("langid", _scorers.clear)
        if key not in _scorers:  # tasks that follow one another in a worker share it
            _scorers.clear()
            _scorers[key] = Scorer(shared.value)
        for batch in common.sliced(batches):
            langs, scores = _scorers[key].predict(common.texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], schema=out_schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def held_out() -> F.Column:
    """The rows that fitting never sees."""
    return F.pmod(common.crc_of_id(F.col("doc_id")), F.lit(5)) == 0


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of `documents`, learnt from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
