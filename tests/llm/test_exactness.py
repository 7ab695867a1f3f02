"""Operators 5, 6 and 8 against plain computations on given models and vectors."""

import math
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from riverlog.llm import op5_topk_search as o5, op6_language_id as o6, op8_toxicity as o8

SF = "/root/testdata/sf0.001"
ODD = ["", None, "   ", "a", "...", "12 34", "same same", "same same", "\u4e2d\u6587", "word " * 5000, "x" * 5000, "Ab. Cd! ef?\ngh"]


def sizes(text, dictionaries):
    """Compressed bytes by each language, each part by a compressor of its own."""
    raw = text.lower().encode()
    words = raw[-400:].split()
    parts = [raw[i : i + 2048] for i in range(0, len(raw), 2048)] + [b" ".join(words[i:]) for i in range(1, min(len(words), 12))]
    how = zstandard.ZstdCompressionParameters.from_level(6, min_match=3)
    raw_content = zstandard.DICT_TYPE_RAWCONTENT
    return {k: sum(len(zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(d, dict_type=raw_content)).compress(p)) for p in parts) for k, d in dictionaries.items()}


def test_languages_by_plain_compression(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    known = o6.train(docs.where(~o6.held_out(F.col("doc_id"))))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    got = {r["doc_id"]: r for r in o6.identify(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert len(got) == len(rows) and len(known) > 1
    for i, text in rows:
        r = got[i]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        (a, best), (b, _) = sorted((n, k) for k, n in sizes(text, known).items())[:2]
        assert r["lang_pred"] == best and math.isclose(r["margin"], (b - a) / a) and r["rejected"] == ((b - a) / a < 0.001)
        assert math.isclose(r["score"], 1 - math.exp(-(b - a) / a / 0.02), abs_tol=1e-12)


def test_languages_of_equal_sizes(spark):
    """Ties go to the first name and are rejected."""
    df = spark.createDataFrame([(1, "some words of a text"), (2, "x")], "doc_id long, text string")
    for r in o6.identify(df, {"a": b"some words", "b": b"some words"}).collect():
        assert (r["lang_pred"], r["score"], r["margin"], r["rejected"]) == ("a", 0.0, 0.0, True)


def test_one_row_of_a_repeated_id_trains(spark):
    rows = [(1, f"words number {i} of one", "en", 1) for i in range(300)] + [(None, f"without id {i}", "en", 0) for i in range(300)] + [(2, "ein anderer text", "de", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    known = o6.train(df, sample_texts=1000)
    assert set(known) == {"en", "de"} and known["en"].count(b"\n") == 1
    seen = []
    real, o8.fit = o8.fit, lambda picked: seen.append(picked) or real(picked)
    try:
        o8.train(df)
    finally:
        o8.fit = real
    assert sorted((r["doc_id"] or 0, r["toxic"]) for r in seen[0]) == [(0, 0), (1, 1), (2, 0)]


def noisy_or(text, model):
    """(score, sentences of 0.5 or more) by the sentences' distinct words, one by one."""
    clean, worst = 1.0, []
    for s in (x for x in re.split(r"(?<=[.!?])\s+|\n+", text or "") if x):
        z = model["bias"]
        for w in set(re.findall(r"\w+", s.lower())):
            for f in (w, *("^" + w[:n] for n in (4, 5, 6) if len(w) > n)):
                z += model["weights"].get(f, 0.0)
        p = 1 / (1 + math.exp(-max(-30, min(30, z))))
        clean *= 1 - min(p, 1 - 1e-12)
        worst += [s] if p >= 0.5 else []
    return 1 - clean, worst


def test_toxicity_by_plain_noisy_or(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    for model in (o8.train_joined(docs, labels), {"bias": -1.0, "weights": {"same": 1.5, "^word": 0.0, "ab": -3.0, "ef": 9.0}}, {"bias": -30.0, "weights": {}}):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
        got = {r["doc_id"]: r for r in o8.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
        for i, text in rows:
            score, worst = noisy_or(text, model)
            assert math.isclose(got[i]["score"], score, abs_tol=1e-9) and got[i]["worst"] == worst


@pytest.mark.parametrize("scale", [1.0, 1e4, 3e6, 1e7])
def test_top_k_in_all_number_types(spark, scale):
    """Inner products beyond what 32-bit and 64-bit floats hold exactly, with ties."""
    rng = random.Random(int(scale))
    rows = [(i, [rng.choice([-1, 1]) * rng.randint(0, 40) / 16 * scale + rng.randint(0, 3) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, v) for i, (_, v) in enumerate(rows[:10])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    got = {}
    for r in o5.top_k(df, F.col("vec_id") % 5 == 0, 7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for i, q in ints:
        if i % 5 == 0:
            every = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ints if j != i)[:7]
            cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
            assert sorted(got[i]) == [(k + 1, j, cut(-s)) for k, (s, j) in enumerate(every)]


def test_search_broadcasts_neither_trees_nor_queries(spark, monkeypatch):
    """Packed files look small; unpacked, and each block once for each cell, they filled the driver."""
    plans, kept = {}, o5.stored
    monkeypatch.setattr(o5, "stored", lambda df, what: (plans.update({what: df}), kept(df, what))[1])
    rng = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(600, 4)).astype(np.float32))]
    plans["end"] = o5.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, 5, shard_rows=64)
    plan = lambda what: plans[what]._jdf.queryExecution().executedPlan().toString().splitlines()
    assert {x.split("SortMergeJoin")[0].strip(" :+-") for x in plan("query-blocks") if "LeftOuter" in x} == {""}
    assert any("CartesianProduct" in x for x in plan("end")) and not any("Broadcast" in x for x in plan("end"))


def test_best_points_of_many_trees(monkeypatch):
    """Ties, the query itself, and more found points than are held: as if all trees were one."""
    rng = np.random.default_rng(4)
    v = rng.integers(-4, 5, size=(3000, 3))
    q = {"points": v[:40], "ids": np.arange(40), "rows": np.arange(40), "tau": np.full(40, -np.inf)}
    best = o5.Best(q, 7)
    best.most = 500
    for part in np.array_split(rng.permutation(3000), 5):
        order, offsets, lo, hi = o5.build_tree(v[part], 64)
        best.search({"points": o5._narrow(v[part][order]), "ids": part[order] // 2, "rows": part[order], "offsets": offsets, "lo": lo, "hi": hi})
    one, ids, rows, scores = best.found()
    for i in range(40):
        want = sorted((-int(v[i] @ v[j]), j // 2, j) for j in range(3000) if j != i)[:7]
        assert [(-int(s), a, b) for s, a, b in zip(scores[one == i], ids[one == i], rows[one == i])] == want
    assert o5._exact(np.array([[-128]], np.int8), np.array([[1 << 17]])) is np.float64
