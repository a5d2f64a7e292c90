"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

Items are normalised to words; the automaton of all items streams over a document's words and keeps
the longest matching length at each. A match of WINDOW words or more covers its words, and so does a
whole item that has fewer words. Words that no item has, and neighbours that no item has side by
side, can't be in a match: they are passed over without a step of the automaton.

An automaton holds AUTOMATON_WORDS words of items at most (or one item). More items are dealt over
several automata, and the documents pass them one after another, so memory stays bounded.

Defined results: null and empty texts have no words; items of null or wordless text match nothing;
equal items each count, under their own ids; rows with one item_id are one item; items without an id
cover words, but are neither counted nor listed; repeated rows are judged each; an empty benchmark leaves every
document clean; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 10
AUTOMATON_WORDS = 500_000
#: A-Z to a-z, and what no word has to blanks.
TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with what each window belongs to."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        texts = [[number.setdefault(w, len(number)) for w in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for t in texts:
            last = 0
            for c in t:
                last = self._extend(last, c)
        #: state: the items with a window (or the whole short item) that ends there
        self.items_at: dict[int, set[int]] = {}
        #: state: lengths of the short items that end there
        self.short_at: dict[int, set[int]] = {}
        for k, t in enumerate(texts):
            state = 0
            for i, c in enumerate(t):
                state = self.next[state][c]
                if i + 1 >= window:
                    self.items_at.setdefault(self._shorten(state, window), set()).add(k)
            if 0 < len(t) < window:
                at = self._shorten(state, len(t))
                self.short_at.setdefault(at, set()).add(len(t))
                self.items_at.setdefault((at, len(t)), set()).add(k)
        #: the longest suffix that has short items, for each state
        self.nearest = [-1] * len(self.link)
        for v in sorted(range(len(self.link)), key=self.length.__getitem__):
            if v in self.short_at:
                self.nearest[v] = v
            elif self.link[v] >= 0:
                self.nearest[v] = self.nearest[self.link[v]]
        n = len(number)
        pairs = {a * n + b for t in texts for a, b in zip(t, t[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.least = min([window, *[len(t) for t in texts if t]])

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _shorten(self, state: int, n: int) -> int:
        """The state that holds the last n words of a match that ends in state."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def runs(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of a document that a match may lie in."""
        known = numbers >= 0
        if not known.any():
            return
        joined = known[:-1] & known[1:]
        at = np.flatnonzero(joined)
        if len(at) and len(self.pairs):
            codes = numbers[at].astype(np.int64) * len(self.vocabulary) + numbers[at + 1]
            k = np.minimum(self.pairs.searchsorted(codes), len(self.pairs) - 1)
            joined[at] = self.pairs[k] == codes
        else:
            joined[:] = False
        cut = np.flatnonzero(~joined) + 1
        starts = np.concatenate([[0], cut])
        ends = np.append(cut, len(numbers))
        for s, e in zip(starts[(ends - starts) >= self.least], ends[(ends - starts) >= self.least], strict=True):
            if known[s]:
                yield int(s), int(e)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit stretches [start, end) in order, merged, and the numbers of the items found."""
        get = self.vocabulary.get
        numbers = np.array([get(w, -1) for w in words], np.int32)
        hits: list[tuple[int, int]] = []
        found: set[int] = set()
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for s, e in self.runs(numbers):
            state = matched = 0
            for i in range(s, e):
                c = int(numbers[i])
                while state and c not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if c in nxt[state]:
                    state = nxt[state][c]
                    matched += 1
                    cover = 0
                    if matched >= window:
                        cover = matched
                        found |= self.items_at[self._shorten(state, window)]
                    v = self.nearest[state]
                    while v >= 0:
                        for n in self.short_at[v]:
                            if n <= matched:
                                cover = max(cover, n)
                                found |= self.items_at[v, n]
                        v = self.nearest[link[v]] if link[v] >= 0 else -1
                    if cover:
                        a = i + 1 - cover
                        while hits and hits[-1][1] >= a:
                            a = min(a, hits.pop()[0])
                        hits.append((a, i + 1))
        return hits, found


def automata(benchmark: DataFrame, window: int = WINDOW, most: int = AUTOMATON_WORDS) -> Iterator[Automaton]:
    """Automata of the items, each of at most `most` words (or one item)."""
    held: list[tuple[str | None, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    for r in rows.toLocalIterator():
        words = words_of(r["text"])
        if held and size + len(words) > most:
            yield Automaton(held, window)
            held, size = [], 0
        held.append((r["item_id"], words))
        size += len(words)
    yield Automaton(held, window)


#: What a pass adds to rows: how many words, word starts and ends of hits (flat), ids of items found.
EXTRA = [T.StructField("__n_words", T.LongType()), T.StructField("__hits", T.ArrayType(T.LongType())), T.StructField("__items", T.ArrayType(T.StringType()))]
Finish = Callable[[pa.RecordBatch], pa.RecordBatch]


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW, most: int = AUTOMATON_WORDS, finish: Finish | None = None, schema: T.StructType | None = None) -> DataFrame:
    """docs' rows: the columns of keep, the text, __n_words, __hits and __items; or what finish makes
    of batches of them, in the pass that finds the last hits."""
    spark = docs.sparkSession
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("__text"), F.lit(0).cast("long").alias("__n_words"), F.lit(None).cast("array<bigint>").alias("__hits"), F.lit(None).cast("array<string>").alias("__items"))
    whole = T.StructType([*rows.schema.fields[: len(keep) + 1], *EXTRA])
    coming = automata(benchmark, window, most)
    automaton = next(coming)
    while automaton is not None:
        later = next(coming, None)
        step = _pass(spark.sparkContext.broadcast(automaton), finish if later is None else None)
        if later is None:
            return rows.mapInArrow(step, schema or whole)
        # the next automaton: what went before is a table, so that one is held at a time
        rows = common.written(rows.mapInArrow(step, whole), "decontaminate")
        automaton = later


def _pass(shared, finish: Finish | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.hold("automaton", lambda: None)
        automaton = shared.value
        for batch in common.sliced(batches, name="__text"):
            n = batch.num_columns
            counts, spans, items = [], [], []
            for text, hits0, items0 in zip(batch.column(n - 4).to_pylist(), batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True):
                words = words_of(text or "")
                hits, found = automaton.scan(words)
                if hits0:
                    hits = merged(hits + list(zip(hits0[::2], hits0[1::2], strict=True)))
                counts.append(len(words))
                spans.append([x for pair in hits for x in pair])
                items.append(sorted({automaton.names[k] for k in found}.difference([None]).union(items0 or [])))
            out = pa.RecordBatch.from_arrays([*batch.columns[: n - 3], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)
            yield finish(out) if finish else out

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without_words(text: str, spans: list[int]) -> str:
    """The text less the words in [start, end) of each pair, with what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    is_word = np.frombuffer(raw.translate(TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at : int(starts[a])])
        at = int(ends[b - 1])
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """docs less the spans that items match, and less the documents of which they cover more than
    max_coverage. All columns stay; n_chars follows the text where there is such a column."""
    names = docs.columns
    keep = [f"__c{i}" for i in range(len(names))]
    at = names.index("text")
    renamed = docs.toDF(*keep)
    out_schema = T.StructType([T.StructField(k, f.dataType) for k, f in zip(keep, docs.schema.fields, strict=True)])
    n_chars = names.index("n_chars") if "n_chars" in names else None

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(keep)
        texts, counts, spans = (batch.column(k).to_pylist() for k in (at, n + 1, n + 2))
        stays, changed = [], list(texts)
        for i, (t, s, c) in enumerate(zip(texts, spans, counts, strict=True)):
            covered = sum(b - a for a, b in zip(s[::2], s[1::2], strict=True))
            stays.append(not covered or covered <= max_coverage * c)
            if covered and stays[-1]:
                changed[i] = without_words(t, s)
        columns = list(batch.columns[:n])
        columns[at] = pa.array(changed, pa.string())
        if n_chars is not None:
            lengths = [len(t) if t is not u else x for t, u, x in zip(changed, texts, columns[n_chars].to_pylist(), strict=True)]
            columns[n_chars] = pa.array(lengths, columns[n_chars].type)
        return pa.RecordBatch.from_arrays(columns, names=keep).filter(pa.array(stays))

    # in one pass, so that a task holds one Python worker
    return matches(renamed, benchmark, keep, text=keep[at], window=window, finish=cut, schema=out_schema).toDF(*names)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document of `documents` shares with the items of `benchmark`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    covered = F.aggregate("__hits", F.lit(0).cast("long"), lambda a, x: x - a)  # ends less starts, by turns
    return found.select("doc_id", F.col("__n_words").alias("n_words"), covered.alias("n_hit"), F.size("__items").cast("long").alias("n_items"), F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("__hits") > 0).alias("contaminated"))
