"""The registered queries and the pipeline, as a driver calls them, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lodestar.llm import common, decontaminate, ngram_join, packing, quality, secrets
from lodestar.llm.encoding import tokenizer_path
from tests.llm.test_operators import brute_components, plain_personal_data

SECRET = hashlib.sha1(b"registered").hexdigest()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables: good texts of two languages, junk, copies, benchmark passages, secrets, odd rows."""
    at = tmp_path_factory.mktemp("sf")
    rng = np.random.default_rng(21)
    words = {"en": ["the", "house", "walks", "river", "under", "green", "while", "people", "bright", "morning"], "de": ["der", "hund", "schläft", "über", "straße", "und", "wieder", "grün", "morgen", "licht"]}
    sentence = lambda lang, n: " ".join(rng.choice(words[lang], n)).capitalize() + "."
    benchmark = [(1, "Zeta " + sentence("en", 11)), (2, "quick omega"), (3, None), (4, "Psi " + sentence("de", 14)), (5, "..."), (5, "Theta " + sentence("en", 12)), (6, "Theta " + sentence("en", 9))]
    rows = []
    for i in range(120):
        lang = "de" if i % 3 == 0 else "en"
        text = "\n".join(sentence(lang, int(rng.integers(4, 15))) for _ in range(int(rng.integers(3, 9))))
        if i % 10 == 1:
            text = "&&& $$$ ### " * int(rng.integers(5, 20)) + text[:20].upper()
        if i % 17 == 5:
            text += " " + benchmark[0][1].lower() + " end of it"
        if i % 23 == 4:
            text += f'\ntoken = "{SECRET}" or user{i}@mail.example.com, 10.0.0.{i}, 4111 1111 1111 1111 and +1 (555) 010-{i:04d}'
        if i % 19 == 7:
            text += " A quick OMEGA once."
        rows.append((i, text, lang if i % 5 else None, "s", len(text)))
    rows += [(200 + i, rows[2 * i][1], "en", "copy", 1) for i in range(10)]
    rows += [(300 + i, rows[2 * i][1].replace("under", "u", 1), "en", "near", 1) for i in range(10)]
    rows += [(400, None, None, None, None), (401, "", "en", None, 0), (402, " 12 ²½ ", "en", None, 5), (403, "one\ttwo  three", None, None, 14), (404, "Word. " * 9000, "en", None, 54000)]
    labels = [(i, int(i % 10 != 1), 0) for i in range(120) if i % 7] + [(0, None, 1), (None, 1, 0)]
    make = lambda data, schema, name: spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{at}/{name}.parquet")
    make(rows, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    make(labels, "doc_id long, quality int, toxic int", "labels")
    make(benchmark, "item_id long, text string", "benchmark")
    return str(at)


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def run(spark, sf, name):
    return __spark_entry__.queries()[name](spark, sf).collect()


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_id(spark, sf, texts):
    got = {r["doc_id"]: r for r in run(spark, sf, "op1_language_id")}
    assert set(got) == set(texts) and all(r["held_out"] == (remainder(i, 5) == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    plain = [i for i in range(120) if i % 10 != 1]
    assert np.mean([got[i]["lang_pred"] == ("de" if i % 3 == 0 else "en") for i in plain]) > 0.95
    assert [got[i]["lang_pred"] for i in (400, 401, 402)] == ["und"] * 3


def test_token_output(spark, sf, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    at, want = 0, []
    for i in sorted(texts):
        ids = [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, sf, "op2_token_output")) == want


def plain_score(net, text):
    """The network's score of one text, chunk by chunk."""
    raw = text.encode()
    raw += bytes(-len(raw) % quality.HALF + (0 if raw else quality.CHUNK)) + bytes(quality.HALF if raw else 0)
    blocks = [net["embed"][np.frombuffer(raw[a : a + quality.CHUNK], np.uint8)].reshape(-1) for a in range(0, len(raw) - quality.HALF, quality.HALF)]
    conv = np.concatenate([net["conv"][:, : quality.FILTERS], net["conv"][:, quality.FILTERS :]])
    best = np.max([b @ conv + net["bias"] for b in blocks], axis=0)
    return 1 / (1 + np.exp(-(np.maximum(best, 0).astype(np.float64) @ net["out"] + net["out_bias"][0])))


def test_quality_classifier(spark, sf, texts):
    got = {r["doc_id"]: r for r in run(spark, sf, "op3_quality_classifier")}
    assert set(got) == set(texts) and all(r["held_out"] == (remainder(i, 4) == 2) and r["predicted"] == int(r["score"] >= 0.7) for i, r in got.items())
    held = [i for i in range(120) if got[i]["held_out"]]
    assert np.mean([(got[i]["score"] > 0.5) == (i % 10 != 1) for i in held]) > 0.9
    net = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").where(~quality.held_out()))
    for i in (0, 1, 11, 50, 400, 401, 403):
        assert abs(plain_score(net, texts[i] or "") - got[i]["score"]) < 1e-4


def plain_hits(text, items, window=10):
    """Which words an item's windows cover, and the ids of items with a window in the text."""
    words = decontaminate.words_of(text or "")
    hit, found = [False] * len(words), set()
    for name, item in items:
        own = decontaminate.words_of(item or "")
        n = min(window, len(own))
        for j in range(len(own) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[j : j + n]:
                    hit[i : i + n] = [True] * n
                    found.add(name)
    return words, hit, found


def test_benchmark_decontamination(spark, sf, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in run(spark, sf, "op4_benchmark_decontamination")}
    assert set(got) == set(texts) and sum(r["contaminated"] for r in got.values()) > 8
    for i, text in texts.items():
        words, hit, found = plain_hits(text, items)
        names = ",".join(sorted(map(str, found)))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["contaminated"], got[i]["items_sha256"]) == (len(words), sum(hit), len(found), any(hit), hashlib.sha256(names.encode()).hexdigest()), i


def test_secret_scan(spark, sf, texts):
    want = {(i, m.start(), m.end()) for i, t in texts.items() for m in re.finditer(SECRET, t or "")}
    got = run(spark, sf, "op5_secret_scan")
    assert {(r["doc_id"], r["start"], r["end"]) for r in got} == want and len(want) > 4
    assert all(r["hit"] == SECRET and r["probability"] >= 0.5 for r in got)


def test_personal_data(spark, sf, texts):
    got = {r["doc_id"]: r for r in run(spark, sf, "op8_personal_data")}
    assert set(got) == set(texts)
    for i, text in texts.items():
        spans = plain_personal_data(text or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert got[i]["n_spans"] >= len(spans) and set(line.split(",")) <= set(got[i]["spans"].split(","))


def check_packing(rows, texts, capacity=4096):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want, counts = set(), {}
    for i, text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.add((i, k, a, len(part), zlib.crc32(part.tobytes())))
            counts[len(part)] = counts.get(len(part), 0) + 1
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        ends = [0]
        for a, n in sorted(spans):
            assert a == ends[-1]
            ends.append(a + n)
        assert ends[-1] <= capacity
    assert len(by) == packing.lower_bound(counts, capacity)


def test_best_fit_packing(spark, sf, texts):
    check_packing(run(spark, sf, "op9_best_fit_packing"), list(texts.items()))


def test_ngram_jaccard_join(spark, sf, texts):
    got = run(spark, sf, "op10_ngram_jaccard_join")
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == brute_components(sorted(texts.items()), 3, 90, 100)
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    size = lambda w: len({tuple(w[j : j + 3]) for j in range(len(w) - 2)}) if len(w) > 2 else min(1, len(w))
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: size(w) for i, w in words.items()}


def test_substring_dedup_and_top_k_have_sql():
    assert {"op6_exact_top_k", "op7_substring_dedup"} <= set(__spark_entry__.oracle_sql())


def test_pipeline_stages(spark, sf):
    """Each stage on what the one before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = common.written(stage(spark, docs, sf), f"test{k}")
        rows = out.collect()
        seen.append(len(rows))
        after = {r["doc_id"]: r["text"] for r in rows} if name != "packing" else {}
        if name != "packing":
            assert out.columns == columns
        if name == "quality":
            net = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet").where(~quality.held_out()))
            scores = {i: plain_score(net, t or "") for i, t in before.items()}
            assert {i for i, s in scores.items() if s > 0.7001} <= set(after) <= {i for i, s in scores.items() if s > 0.6999}
            assert all(after[i] == before[i] for i in after)
        elif name == "near duplicates":
            groups = brute_components(sorted(before.items()), 5, 80, 100)
            assert after == {c: before[c] for _, c in groups} and len(after) < len(before)
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = {}
            for i, t in before.items():
                words, hit, _ = plain_hits(t, items)
                if not any(hit):
                    want[i] = t
                elif sum(hit) <= len(words) / 2:
                    want[i] = [w for w, h in zip(words, hit, strict=True) if not h]
            assert set(after) == set(want)
            assert all(after[i] == w if not isinstance(w, list) else decontaminate.words_of(after[i]) == w for i, w in want.items())
            assert any(isinstance(w, list) for w in want.values())
        elif name == "secrets":
            assert after == {i: None if t is None else t.replace(SECRET, secrets.MASK) for i, t in before.items()} and after != before
            assert all(r["n_chars"] == len(r["text"]) for r in rows if secrets.MASK in (r["text"] or ""))
        else:
            check_packing(rows, list(before.items()))
        docs = out
    assert len(corpus_pipeline.run(spark, sf).collect()) == seen[-1]


def test_pipeline_of_empty_tables(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name in __spark_entry__.queries():
        if name.startswith("op") and not name.startswith(("op6", "op5")):
            assert __spark_entry__.queries()[name](spark, str(tmp_path)).count() == 0
    assert ngram_join.near_duplicates(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 0
