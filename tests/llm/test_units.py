"""Parts that need no Spark, against brute force."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lodestar.llm import decontaminate, encoding, langid, line_dedup, ngram_join, packing, quality, token_output

TEXTS = ["", " ", "\n", "plain words here", "  two  blanks ", "a\n\nb", "tab\tand nbsp", "it's 12,345.6 ok'll\nNew line", "été über ñandú", "漢字 テスト", "x" * 300, "<|endoftext|> a", "foo ́bar", "a \nb"]


@pytest.mark.parametrize(("name", "blanks"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_encoding_is_exact(name, blanks):
    enc = encoding.Encoder(encoding.tokenizer_path(name), blanks, 3)
    for _ in range(3):
        assert enc.ids(TEXTS) == [np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]


@pytest.mark.parametrize(("name", "blanks"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_encoding_is_exact_on_mixed_white_space(name, blanks):
    words = ["a", "one", "it's", "'ll", "12", "\u00df", "\u6f22\u5b57", "\u0301b", "\u03a3", "\u0130", "<|endoftext|>", "<|", "|>", "<|startoftext|>", "!?", "\x01", "\x00", "\x7f", "\xad"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r", "\u00a0", "\u3000", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\x0b", "\u2028", "\u200b", "\ufeff", "\u180e", ""]
    rng = random.Random(5)
    enc = encoding.Encoder(encoding.tokenizer_path(name), blanks, 50)
    for _ in range(40):
        texts = ["".join(x for _ in range(rng.randint(0, 7)) for x in (rng.choice(gaps), rng.choice(words), rng.choice(gaps))) for _ in range(60)]
        assert enc.ids(texts) == [np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("block", [1, 7, 64])
def test_shards_round_trip(bits, block):
    rng = np.random.default_rng(1)
    docs = [(None, b""), *[(i, rng.integers(0, 1 << 32 if i % 2 else 50_000, rng.integers(0, 40), dtype=np.uint64).astype("<u4").tobytes()) for i in range(20)]]
    shard = token_output.Shard(token_output.write_shard(docs, block, bits))
    assert shard.ids().tobytes() == b"".join(x for _, x in docs)
    for (d, x), own, null, s, n in zip(docs, shard.doc_ids, shard.nulls, shard.starts, shard.counts, strict=True):
        assert (None if null else int(own)) == d and shard.ids(int(s), int(n)).tobytes() == x
    assert token_output.Shard(token_output.write_shard([])).ids().size == 0


def optimum(items, capacity):
    """Fewest bins, by search over placements."""
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in sorted(set(rooms), reverse=True):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best


def test_packing_is_optimal_on_small_cases():
    rng = random.Random(3)
    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(0, 9))), reverse=True)
        counts = {n: items.count(n) for n in items}
        got = packing.plan(counts, 20)
        assert sorted(x for p, n in got.items() for x in p * n) == sorted(items) and all(sum(p) <= 20 for p in got)
        assert sum(got.values()) == optimum(items, 20) if items else got == {}
        assert packing.lower_bound(counts, 20) <= sum(got.values()) if items else True


def test_bin_completion_beats_best_fit():
    counts = {6: 2, 5: 2, 4: 2, 3: 4, 2: 1}
    best_fit = {(6,): 2, (5, 4): 2, (3, 3, 3): 1, (3, 2): 1}
    assert sum(packing.bin_completion(counts, 10, best_fit).values()) == -(-(12 + 10 + 8 + 12 + 2) // 10)


@pytest.mark.parametrize("n", [2, 600, 6_000_000])
def test_completion_spans_the_whole_histogram(n):
    counts = {2058: n, 1044: n, 1034: n, 1004: 2 * n}
    got = packing.plan(counts, 4096)
    assert sum(got.values()) == packing.lower_bound(counts, 4096) == 3 * n // 2
    assert {x: sum(k * p.count(x) for p, k in got.items()) for x in counts} == counts and max(map(sum, got)) <= 4096
    # and the best of more fillings than are asked for comes first
    assert packing.fillings([9, 8, 7, 2], {9: 9, 8: 9, 7: 9, 2: 9}, 16, 16, 1) == [(9, 7)]


def test_large_counts_stay_cheap():
    counts = {n: 10_000_000 + n for n in range(1, 4097, 3)}
    got = packing.plan(counts, 4096)
    total = {}
    for p, n in got.items():
        for x in p:
            total[x] = total.get(x, 0) + n
    assert total == counts and len(got) < 20_000


def brute(doc, items, window):
    hit, found = set(), set()
    for name, words in items:
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            for j in range(len(doc) - m + 1):
                if doc[j : j + m] == words[i : i + m]:
                    hit.update(range(j, j + m))
                    found.add(name)
    return hit, found


def test_automaton_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        letters = [bytes([97 + i]) for i in range(rng.choice([1, 2, 4]))]
        items = [(str(k), [rng.choice(letters) for _ in range(rng.randint(0, 9))]) for k in range(rng.randint(0, 5))]
        auto = decontaminate.Automaton(items, 4)
        doc = [rng.choice([*letters, b"z"]) for _ in range(rng.randint(0, 40))]
        hits, found = auto.scan(doc)
        hit, names = brute(doc, items, 4)
        assert {i for a, b in hits for i in range(a, b)} == hit and {auto.names[k] for k in found} == names, (items, doc)


def test_words_and_removal():
    assert decontaminate.words_of("Ab-c_D é1\u0000x") == [b"ab", b"c", b"d", "é1".encode(), b"x"]
    assert decontaminate.without_words("A b, c d. E", [1, 3]) == "A  d. E" and decontaminate.without_words("a b", [0, 2]) == ""


@pytest.mark.parametrize("k", [1, 3, 5])
def test_shingles(k):
    t = "A b\tC d a\nB c é " * 3
    w = t.lower().split()
    assert len(ngram_join.shingles(t, k)) == len({tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    assert len(ngram_join.shingles("one", 3)) == 1 and len(ngram_join.shingles(" ", 3)) == 0 and len(ngram_join.shingles(None, 3)) == 0
    assert ngram_join.set_id(ngram_join.shingles("X y", 3)) == ngram_join.set_id(ngram_join.shingles("x  Y", 3)) != ngram_join.set_id(ngram_join.shingles("xy", 3))


def test_overlap_and_suffix_filter():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 1 << 63, 30, dtype=np.uint64) >> np.uint64(57)) for _ in range(2))
        true = len(np.intersect1d(a, b))
        assert ngram_join._overlap(a, b, 0) == true
        assert (ngram_join._overlap(a, b, true + 1) >= true + 1) is False and ngram_join._overlap(a, b, true) >= true


def test_classifier_learns_and_is_blind_to_segments(monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    good = [" ".join(rng.choice(words) for _ in range(60)).encode() for _ in range(60)]
    bad = [" | ".join(rng.choice(words).upper() + "!!" for _ in range(40)).encode() for _ in range(60)]
    net = quality.train(good[:50] + bad[:50], np.array([1.0] * 50 + [0.0] * 50), epochs=8)
    s = quality.score(net, good[50:] + bad[50:] + [b""])
    assert (s[:10] >= 0.7).all() and (s[10:20] < 0.7).all() and 0 <= s[20] <= 1
    long = good[0] * 300 + bad[0]
    whole = quality.score(net, [long, good[1]])
    monkeypatch.setattr(quality, "SEGMENT", 64)
    monkeypatch.setattr(quality, "GROUP", 256)
    assert np.allclose(quality.score(net, [long, good[1]]), whole, atol=1e-5) and whole[0] < 0.7
    assert quality.score(quality.train([], np.array([])), [b"x"])[0] == 1.0 and quality.score(quality.train([b"x"], np.array([0.0])), [b"x"])[0] == 0.0


def test_classifier_trains_on_whole_texts():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(5000)) + mark * 8 for _ in range(60) for mark in (b"ZQXJ", b"#7+%")]
    labels = np.array([1.0, 0.0] * 60)
    net = quality.train(texts[:80], labels[:80])
    assert ((quality.score(net, texts[80:]) > 0.5) == (labels[80:] > 0.5)).mean() > 0.9


def test_scores_come_from_the_text_alone():
    rng = np.random.default_rng(6)
    texts = [b"", *[rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (1, 7, 8, 9, 16, 40, 40_000)], b""]
    net = quality.train(texts * 3, np.arange(27) % 2, epochs=2)
    alone = np.array([quality.score(net, [t])[0] for t in texts])
    for _ in range(20):
        order = rng.permutation(len(texts))
        assert np.allclose(quality.score(net, [texts[i] for i in order]), alone[order], atol=1e-6)
    top, chunk = quality.winners(net, texts)
    assert np.allclose(np.maximum(top, 0), quality.pooled(net, texts), atol=1e-5) and not chunk[0].any()


def test_backoff_to_shorter_grams():
    langs, totals = ["aa", "bb"], {(x, k): 100 for x in ("aa", "bb") for k in range(6)}
    model = {"langs": langs, "words": langid._table({"hi": {0: 50}}, langs, totals, level=0), "grams": langid._table({"zz": {1: 40}, "q": {0: 30, 1: 2}}, langs, totals)}
    s = langid.Scorer(model)
    names, scores = s.predict(["Hi, hi", "xzzx", "q1", "123", "", "é", "\u00b2 \u00bd \u2167"])
    assert names == ["aa", "bb", "aa", "und", "und", "aa", "und"] and scores[3] == 0 and scores[0] > 0.99 and abs(scores[5] - 0.5) < 1e-6
    assert (names, scores) == s.predict(["Hi, hi", "xzzx", "q1", "123", "", "é", "\u00b2 \u00bd \u2167"])
    # brute force of the backoff: a known word, else the mean of the longest known n-grams
    rng = random.Random(8)
    for _ in range(200):
        w = "".join(rng.choice("hizqx") for _ in range(rng.randint(1, 5)))
        seen = {"hi": {0: 50}} if w == "hi" else next((f for k in range(5, 0, -1) if (f := {g: {"zz": {1: 40}, "q": {0: 30, 1: 2}}[g] for g in {f"_{w}_"[j : j + k] for j in range(len(w) + 3 - k)} if g in ("zz", "q")})), {})
        many = [g for g in seen for j in range(len(w) + 3 - len(g)) if w == g or f"_{w}_"[j : j + len(g)] == g] if w != "hi" else ["hi"]
        want = [np.mean([np.log((seen[g].get(i, 0) + 0.1) / 1100.0) for g in many]) if many else 0.0 for i in range(2)]
        assert np.allclose(s.word(w), want, atol=1e-4), w
    assert langid.Scorer({"langs": [], "words": langid._table({}, [], {}), "grams": langid._table({}, [], {})}).predict(["a"])[0] == ["und"]


def test_units_tile_lines():
    text = "One. Two!? \u3002x\n\n ... three"
    assert [w for _, _, w in line_dedup.units_of(text)] == [["one"], ["two"], ["x"], ["three"]]
    assert list(line_dedup.units_of("")) == [] and list(line_dedup.units_of("... \n!")) == []
    assert line_dedup.digest(["a", "b"]) != line_dedup.digest(["ab"])
    assert line_dedup.runs([1, 2, 4, 5, 6, 9], [3, 4, 2, 2, 1, 9], 5) == [(1, 2), (4, 6), (9, 9)]


def test_masks_cover_a_segment():
    from lodestar.llm.hamming import masks, segments

    for w in (1, 5, 11):
        assert sorted(x for r in range(w + 1) for x in masks(w, r)) == list(range(1 << w))
    assert all(bin(x).count("1") == 2 for x in masks(16, 2))
    for bits, rows in ((1, 0), (64, 2000), (64, 10**9), (100, 5)):
        widths = segments(bits, rows)
        assert sum(widths) == bits and max(widths) - min(widths) <= 1 and max(widths) <= 24


def test_parts_of_an_index_fit_its_tasks():
    from lodestar.llm.hamming import HELD, parted

    for rows, widths, tasks in ((10, [2, 2], 8), (10**6, [16] * 4, 12), (45 * 10**6, [22, 21, 21], 12)):
        bits, dealt = parted(rows, widths, tasks)
        assert dealt >= tasks and rows / dealt <= HELD and bits <= min(widths)
        assert bits == min(widths) or len(widths) << bits >= 8 * dealt
