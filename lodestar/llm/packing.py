"""Best-fit packing by bin completion with branch and bound, over a histogram of lengths.

How many pieces there are of each length is all that decides how few sequences they need, and there
are at most `capacity` lengths. So the plan is made from that histogram, which does not grow with the
corpus: best-fit decreasing on (length, count) pairs gives the incumbent; where it misses the lower
bound, bin completion runs over the whole histogram: it takes the largest length, enumerates the
undominated fillings of the rest of its sequence, gives one to as many sequences as there are pieces
for, and prunes by the waste that the bound still allows. What is then least full is searched piece by
piece. Pieces find their place by their rank among the pieces of their length.

Defined results: null and empty texts are pieces of the end id alone; repeated rows are packed each;
null doc_ids are packed like others; an empty table gives no rows; other columns are ignored; only
documents longer than the capacity are cut.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .encoding import CACHE_WORDS, encoder, forget, tokenizer_path

#: A pattern is the lengths of a sequence, longest first.
Pattern = tuple[int, ...]
#: Fillings looked at in one search.
NODES = 20_000
#: Fillings to choose from at one place of the whole histogram, and places filled after the first descent.
WIDTH = 4
PLACES = 2_000
#: Incomplete sequences that the search by single pieces takes on.
TAIL = 48
#: No group of pieces that one task ranks is more than about this share of all pieces.
SHARES = 2048


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by the sum, and by pieces that can't share, with what must go
    with them (for each k: pieces over capacity - k are alone; those over half are apart)."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    lengths = sorted(counts)
    for k in {0, *[n for n in lengths if 2 * n <= capacity]}:
        alone = sum(c for n, c in counts.items() if n > capacity - k)
        half = [(n, c) for n, c in counts.items() if capacity - k >= n and 2 * n > capacity]
        rest = sum(n * c for n, c in counts.items() if 2 * n <= capacity and n >= k)
        n_half = sum(c for _, c in half)
        room = capacity * n_half - sum(n * c for n, c in half)
        best = max(best, alone + n_half + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best-fit decreasing, on counts: how many sequences there are of each pattern."""
    open_bins: dict[int, dict[Pattern, int]] = {}
    rooms: list[int] = []  # sorted keys of open_bins
    done: dict[Pattern, int] = {}

    def put(pattern: Pattern, room: int, n: int) -> None:
        if room == 0:
            done[pattern] = done.get(pattern, 0) + n
            return
        if room not in open_bins:
            open_bins[room] = {}
            bisect.insort(rooms, room)
        open_bins[room][pattern] = open_bins[room].get(pattern, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # new sequences, as full of this length as they get
                fit = capacity // length
                n, more = divmod(left, fit)
                if n:
                    put((length,) * fit, capacity - fit * length, n)
                if more:
                    put((length,) * more, capacity - more * length, 1)
                break
            room = rooms[at]
            bins = open_bins[room]
            pattern, n = next(iter(bins.items()))
            fit = room // length
            take = min(n, left // fit)
            if take == 0:
                fit, take = left, 1
            left -= fit * take
            if n == take:
                del bins[pattern]
                if not bins:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                bins[pattern] = n - take
            put(pattern + (length,) * fit, room - fit * length, take)
    for bins in open_bins.values():
        for pattern, n in bins.items():
            done[pattern] = done.get(pattern, 0) + n
    return done


def fillings(lengths: list[int], counts: dict[int, int], room: int, waste: int, most: int) -> list[Pattern]:
    """The first `most` undominated fillings of room with at most `waste` left over: fullest first, then
    longest pieces first, whatever their number. lengths: longest first. A filling is dominated if an
    earlier one has it in part, or longer pieces in the places of its own, or one piece for several."""
    items = [n for n in lengths if n <= room and counts[n]]
    mask = (1 << (room + 1)) - 1
    reach = [1]  # bit t: pieces from here on can add up to t
    for n in reversed(items):
        sums, left, step = reach[-1], min(counts[n], room // n), 1
        while left:
            take = min(step, left)
            sums |= (sums << n * take) & mask
            left -= take
            step *= 2
        reach.append(sums)
    reach.reverse()

    def walk(i: int, left: int) -> Iterator[Pattern]:
        if left == 0:
            yield ()
            return
        for j in range(i, len(items)):
            if not reach[j] >> left & 1:
                return
            for k in range(min(counts[items[j]], left // items[j]), 0, -1):
                if reach[j + 1] >> (left - k * items[j]) & 1:
                    for rest in walk(j + 1, left - k * items[j]):
                        yield (items[j],) * k + rest

    def dominated(p: Pattern) -> bool:
        for q in out:
            a, b = [], list(q)  # what only one of them has
            for x in p:
                if x in b:
                    b.remove(x)
                else:
                    a.append(x)
            if not a or (len(b) == 1 and sum(a) <= b[0]) or (len(a) == len(b) and all(x <= y for x, y in zip(a, b, strict=True))):
                return True
        return False

    out: list[Pattern] = []
    looked = 0
    for target in range(room, max(-1, room - waste - 1), -1):
        if reach[0] >> target & 1:
            for p in walk(0, target):
                looked += 1
                if not dominated(p):
                    out.append(p)
                if len(out) >= most or looked >= 8 * most:
                    return out
    return out


def complete(counts: dict[int, int], capacity: int, incumbent: dict[Pattern, int], bound: int, nodes: int = PLACES) -> dict[Pattern, int]:
    """Bin completion of the whole histogram: the largest length takes its best filling in as many
    sequences as both have pieces for, and so on to the last piece. Further descents turn to another
    filling at one place, then at several, until the bound is met or `nodes` places are spent (the
    first descent is always made). The incumbent stands unless fewer sequences do."""
    best, n_best = incumbent, sum(incumbent.values())
    total = sum(n * c for n, c in counts.items())
    spent = 0

    def descend(turns: dict[int, int]) -> int:
        """One plan; how many places it had before it ended or could not be better."""
        nonlocal best, n_best, spent
        left = {n: c for n, c in counts.items() if c}
        lengths = sorted(left, reverse=True)
        wasted, used, place = 0, {}, 0
        while lengths:
            spent += 1
            spare = (n_best - 1) * capacity - total - wasted  # what may still be wasted by a better plan
            big = lengths[0]
            left[big] -= 1
            turn = turns.get(place, 0)
            found = fillings(lengths, left, capacity - big, spare, turn + 1) if spare >= 0 else []
            left[big] += 1
            if turn >= len(found) or (spent > nodes and turns):
                return place
            place += 1
            pattern = (big, *found[turn])
            need = Counter(pattern)
            n = min(left[x] // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= n * k
            lengths = [x for x in lengths if left[x]]
            wasted += n * (capacity - sum(pattern))
            used[pattern] = used.get(pattern, 0) + n
        if sum(used.values()) < n_best:
            best, n_best = used, sum(used.values())
        return place

    ahead: deque[dict[int, int]] = deque([{}])
    while ahead and n_best > bound and (spent < nodes or not spent):
        turns = ahead.popleft()
        places = descend(turns)
        first = max(turns, default=-1) + 1
        ahead.extend(turns | {at: k} for at in range(first, places) for k in range(1, WIDTH) if len(ahead) < nodes)
    return best


def bin_completion(counts: dict[int, int], capacity: int, incumbent: dict[Pattern, int], nodes: int = NODES) -> dict[Pattern, int]:
    """Branch and bound from the largest piece; the incumbent stands unless fewer sequences do."""
    best = dict(incumbent)
    n_best = sum(best.values())
    bound = lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left = {n: c for n, c in counts.items() if c}
    spent = 0

    def search(used: list[Pattern], wasted: int) -> bool:
        nonlocal best, n_best, spent
        spent += 1
        if spent > nodes:
            return True
        lengths = sorted((n for n, c in left.items() if c), reverse=True)
        if not lengths:
            if len(used) < n_best:
                n_best = len(used)
                best = {}
                for p in used:
                    best[p] = best.get(p, 0) + 1
            return n_best <= bound
        spare = (n_best - 1) * capacity - total - wasted  # what may still be wasted by a better plan
        if spare < 0:
            return False
        big = lengths[0]
        left[big] -= 1
        for filling in fillings(lengths, left, capacity - big, spare, 24):
            room = capacity - big - sum(filling)
            for n in filling:
                left[n] -= 1
            used.append((big, *filling))
            stop = search(used, wasted + room)
            used.pop()
            for n in filling:
                left[n] += 1
            if stop:
                left[big] += 1
                return True
        left[big] += 1
        return False

    if n_best > bound:
        search([], 0)
    return best


def plan(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Patterns and how many sequences have each."""
    out = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    if sum(out.values()) <= bound:
        return out
    out = dict(complete(counts, capacity, out, bound))
    if sum(out.values()) <= bound:
        return out
    # what is left least full is opened again and searched piece by piece
    for tail in (TAIL // 4, TAIL):
        ordered = sorted(out, key=lambda p: (sum(p), p))
        opened: dict[Pattern, int] = {}
        size = 0
        for p in ordered:
            n = min(out[p], tail - size)
            if n <= 0:
                break
            opened[p] = n
            size += n
        sub: dict[int, int] = {}
        for p, n in opened.items():
            for x in p:
                sub[x] = sub.get(x, 0) + n
        better = bin_completion(sub, capacity, opened)
        if sum(better.values()) < size:
            for p, n in opened.items():
                out[p] -= n
                if not out[p]:
                    del out[p]
            for p, n in better.items():
                out[p] = out.get(p, 0) + n
        if sum(out.values()) <= bound:
            break
    return out


def slots(patterns: dict[Pattern, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, the sequence of the first rank, and the place in it. A piece of
    rank r in [first, next first) goes to sequence + (r - first)."""
    rows: dict[int, list[tuple[int, int]]] = {}
    number = 0
    sizes: dict[int, list[int]] = {}
    for pattern, n in sorted(patterns.items(), reverse=True):
        at = 0
        for x in pattern:
            rows.setdefault(x, []).append((number, at))
            sizes.setdefault(x, []).append(n)
            at += x
        number += n
    out = {}
    for x, pairs in rows.items():
        first = np.concatenate([[0], np.cumsum(sizes[x])[:-1]]).astype(np.int64)
        out[x] = (first, np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64))
    return out


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, blanks_count: bool = False, with_ids: bool = False, cache_words: int = CACHE_WORDS, lean: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids: little-endian u32) of every piece. lean: a
    worker keeps no cache from one task to the next."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    out_schema = common.fields(schema)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, blanks_count, cache_words)
        for batch in common.sliced(batches, (1 if lean else 4) << 20, release=forget if lean else None):
            columns: list[list] = [[] for _ in out_schema]
            for doc, ids in zip(batch.column(0).to_pylist(), enc.ids(common.texts_of(batch)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, x in zip(columns, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=False):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces that have a length of 1 to capacity.

    The ranks come from counts of (length, salt): a length has as many salts as it has SHARES of all
    pieces, so that one that a third of them have is dealt over many tasks. Only counts meet at the
    driver, at most capacity + SHARES of them whatever the corpus."""
    sizes = common.written(pieces.groupBy("length").agg(F.count("*").alias("n")), "lengths", few=True)
    share = max(1, (sizes.agg(F.sum("n")).first()[0] or 0) // SHARES)
    # at most `capacity` rows
    salts = F.broadcast(sizes.select("length", F.ceil(F.col("n") / share).cast("int").alias("__salts")))
    rows = pieces.join(salts, "length")
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("__salts")).cast("int")).select(*pieces.columns, "__salt")
    found = rows.groupBy("length", "__salt").agg(F.count("*").alias("n")).collect()
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for r in sorted(found):
        before[r["length"], r["__salt"]] = counts.get(r["length"], 0)
        counts[r["length"]] = counts.get(r["length"], 0) + r["n"]
    table = slots(plan(counts, capacity)) if counts else {}
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")))
    schema = pieces.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ").replace("bigint", "long") + ", sequence_id long, offset long"
    names = pieces.columns
    # the plan has at most a few patterns for each length: bounded by the capacity, not by the corpus
    shared = pieces.sparkSession.sparkContext.broadcast((before, table))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, table = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_pylist()
            salt = batch.column(batch.schema.get_field_index("__salt")).to_pylist()
            rank = batch.column(batch.schema.get_field_index("__rank")).to_pylist()
            sequence, offset = [], []
            for n, s, r in zip(length, salt, rank, strict=True):
                r += before[n, s] - 1
                first, numbers, places = table[n]
                k = int(first.searchsorted(r, side="right")) - 1
                sequence.append(int(numbers[k]) + r - int(first[k]))
                offset.append(int(places[k]))
            keep = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False, cache_words: int = CACHE_WORDS, lean: bool = False) -> DataFrame:
    """Encode, cut and pack documents. Pieces are written to the shared folder once, without texts."""
    return pack(common.written(pieces_of(docs, tokenizer, end_id, capacity, with_ids=with_ids, cache_words=cache_words, lean=lean), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence (little-endian u32), from packed rows with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` in as few sequences of 4096 tokens as bin completion finds."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)
