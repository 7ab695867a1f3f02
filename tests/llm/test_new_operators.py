"""Operators 11 to 13 against brute force, on odd rows and on whole small tables."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from riverlog.llm import common, op11_embedding_dedup as o11, op12_importance_resample as o12, op13_ranked_search as o13

SF = "/root/testdata/sf0.001"
ODD = ["", None, "   ", "a", "word " * 3000, "Ab-cd 3É ß", "same same", "same same", "!!! ???", "中文 9"]
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORDS.findall(text or "")]


def docs(spark, rows):
    """With columns that operators use for themselves."""
    return spark.createDataFrame([(i, t, 1, 2, "f", "t") for i, t in rows], "doc_id long, text string, rank int, score long, file string, term string")


def test_words_in_parts_are_those_of_the_whole():
    rng = random.Random(3)
    for part in (1, 2, 7, 50):
        text = "".join(rng.choice("aB9é-. \n中") for _ in range(400))
        runs = list(common.word_runs(text.encode(), part))
        assert [w.decode() for r in runs for w in r] == words(text) and all(runs)
    assert list(common.word_runs(None)) == list(common.word_runs(b"")) == list(common.word_runs(b" -!")) == []
    assert [w for r in common.word_runs(b"x" * 20_000, 10) for w in r] == [b"x" * 20_000]


# Importance resampling


def features(text, grams=3):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]


def resampled(rows, target, percent, min_words, buckets=10_000, seed=42):
    """Sorted (doc_id, n_features, weight, score, rank), by plain Python."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(at(f) for x in texts for f in features(x)) for texts in ([x for _, x in rows], target))
    a, b = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[i] + 1) * a / ((s[i] + 1) * b))) for i in range(buckets)]
    out = []
    for i, x in rows:
        f = features(x)
        weight = sum(gain[at(y)] for y in f)
        u = None if i is None else (int(sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append([i, len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log(u))), None, len(words(x)) >= min_words and i is not None])
    may = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = k + 1
    return sorted((r[:5] for r in out), key=repr)


def drawn(df):
    return sorted(([r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]] for r in df.collect()), key=repr)


def test_resample_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert drawn(o12.op12_importance_resample(spark, SF)) == resampled(rows, target, 5, 20)


def test_resample_edges(spark, monkeypatch):
    monkeypatch.setattr(o12, "BLOCK_ENTRIES", 8)
    rows = [*enumerate(ODD), (None, "no id here at all"), (3, "other text of a repeated id"), (5, ODD[5]), (5, ODD[5])]
    items = spark.createDataFrame([(1, "Same word", "x"), (2, None, "x"), (2, "3É ß", "x")], "item_id long, text string, doc_id string")
    got = drawn(o12.resample(docs(spark, rows), items, percent=60, min_words=1))
    assert got == resampled(rows, ["Same word", None, "3É ß"], 60, 1)
    assert sum(r[4] is not None for r in got) == 60 * 9 // 100
    assert drawn(o12.resample(docs(spark, rows), items.limit(0), percent=100, min_words=0)) == resampled(rows, [], 100, 0)
    assert drawn(o12.resample(docs(spark, []), items)) == []
    few = drawn(o12.resample(docs(spark, rows), items, percent=60, min_words=1, buckets=7))
    assert few == resampled(rows, ["Same word", None, "3É ß"], 60, 1, buckets=7)


def test_runs_across_parts_of_a_text(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "c", "é", "9"]) for _ in range(300))
    want = np.bincount([zlib.crc32(f.encode()) % 97 for f in features(text)], minlength=97)
    for part in (1, 5, 40, 1 << 20):
        monkeypatch.setattr(common, "WORD_BYTES", part)
        n, got = o12.bucket_counts(text.encode(), 97)
        assert n == 300 and (got == want).all()


def test_matrix_rows_are_the_texts(spark):
    """The stored blocks hold each row's counts; narrow counts widen where they must."""
    rows = [(1, "a a b"), (2, None), (3, "a " * 70_000)]
    got = o12.count_matrix(docs(spark, rows).coalesce(1)).collect()
    held = {}
    for r in got:
        ends, at, n = np.frombuffer(r["indptr"], "<u8"), np.frombuffer(r["indices"], "<u2"), np.frombuffer(r["counts"], f"<u{r['width']}")
        for k, i in enumerate(r["doc_ids"]):
            a, b = int(ends[k]), int(ends[k + 1])
            held[i] = Counter(dict(zip(at[a:b].tolist(), n[a:b].tolist())))
    assert held == {i: Counter(zlib.crc32(f.encode()) % 10_000 for f in features(t)) for i, t in rows}


# Ranked search


def searched(rows, items, k):
    rows = [(i, Counter(words(t))) for i, t in rows if i is not None and words(t)]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item in {i for i, _ in items}:
        q = Counter(w for i, t in set(items) if i == item for w in words(t))
        found = []
        for i, c in rows:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(x * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, x in q.items() if c[t])
            if score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=repr)


def test_search_whole_table(spark):
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert found(o13.op13_ranked_search(spark, SF)) == searched(rows, items, 10)


@pytest.mark.parametrize("shard_docs,shard_postings,block,first", [(3, 1 << 19, 2, 2), (1, 1 << 19, 1024, 1), (8192, 5, 1, 3), (8192, 1 << 19, 1024, 16)])
def test_search_edges(spark, shard_docs, shard_postings, block, first):
    rng = random.Random(8)
    rows = [*enumerate(ODD), (None, "same without id"), (6, "same same"), (6, "same again"), *((100 + i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 40)))) for i in range(60))]
    items = [(1, "a b aa"), (2, None), (3, "Same SAME, word"), (3, "Same SAME, word"), (3, "ab"), (None, "h g"), (5, "nowhere"), (6, "  "), (7, " ".join("abcdefgh"))]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, q int")
    got = o13.ranked(docs(spark, rows), df, 5, shard_docs, shard_postings, block, first)
    assert found(got) == searched(rows, items, 5)


def test_search_of_nothing(spark):
    rows, items = docs(spark, enumerate(ODD)), spark.createDataFrame([(1, "same")], "item_id long, text string")
    assert found(o13.ranked(rows.limit(0), items)) == found(o13.ranked(rows, items.limit(0))) == found(o13.ranked(docs(spark, [(1, None)]), items)) == []


def test_tree_keeps_lists_in_order():
    """Each level's first impacts are the greatest of a range, and a leaf's is the document's own."""
    rng = np.random.default_rng(2)
    for n_docs in (1, 2, 3, 64, 100):
        dfs = rng.integers(1, n_docs + 1, 30)
        docs_ = np.concatenate([np.sort(rng.choice(n_docs, d, replace=False)) for d in dfs]).astype(np.uint16)
        tfs, lengths = rng.integers(1, 5, len(docs_)), rng.integers(1, 300, n_docs)
        at, impacts = o13.ordered(docs_, tfs, dfs, lengths, 1000, 100_000)
        ends = np.cumsum(dfs)
        want = np.zeros((30, n_docs), np.int64)
        want[np.repeat(np.arange(30), dfs), at] = impacts
        assert all((np.diff(impacts[a:b]) <= 0).all() for a, b in zip(ends - dfs, ends))
        tree = o13.Tree(n_docs, o13.wavelet(at, n_docs), impacts)
        for _ in range(10):
            pick, weights = rng.choice(30, 4, replace=False), rng.integers(0, 50, 4)
            best = o13.Best(3, 1)
            best.doc_ids = np.arange(n_docs)
            tree.search((ends - dfs)[pick], ends[pick], weights, best)
            scores = weights @ want[pick]
            assert best.rows == sorted((-int(s), i) for i, s in enumerate(scores) if s > 0)[:3]


# Near-duplicate vectors


def linked(rows, threshold):
    """vec_id, n_links, component_id, kept of each row, over all pairs."""
    def direction(label, vec_id, v):
        if label is None or vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float) / max(map(abs, v))
        return x / np.sqrt(x @ x)

    unit = [direction(label, i, v) for i, label, v in rows]
    link = [[a != b and x is not None and y is not None and rows[a][1] == rows[b][1] and len(x) == len(y) and float(x @ y) >= threshold for b, y in enumerate(unit)] for a, x in enumerate(unit)]
    out = []
    for a, (i, _, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            new = {b for b, y in enumerate(link[todo.pop()]) if y} - seen
            seen |= new
            todo += new
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((i, sum(link[a]), least, i is None or i == least))
    return sorted(out, key=repr)


def joined(df):
    return sorted((tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in df.collect()), key=repr)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, label, v, 1, "g", 0.5) for i, label, v in rows], f"vec_id long, label int, embedding array<{kind}>, id int, grp string, r double")


def cluster(rng, n, spread, dim=16):
    """n vectors around a direction, each turned away from it by up to `spread` radians."""
    c = rng.standard_normal(dim)
    c /= np.linalg.norm(c)
    side = rng.standard_normal((n, dim))
    side -= np.outer(side @ c, c)
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    turn = rng.uniform(0, spread, n)[:, None]
    return np.cos(turn) * c + np.sin(turn) * side


@pytest.mark.parametrize("tile", [512, 4])
def test_vectors_in_crowded_places(spark, tile):
    """Copies, tight and loose groups, and groups about as wide as the threshold's angle: every link counts, across tiles and balls."""
    rng = np.random.default_rng(1)
    parts = [cluster(rng, 60, s) * rng.uniform(0.1, 9) for s in (0.0, 0.02, 0.1, 0.2, 0.25, 0.37, 0.5)] + [cluster(rng, 1, 0) for _ in range(80)]
    x = rng.permutation(np.concatenate(parts)).astype(np.float32)
    rows = [(int(i), k % 3, v.tolist()) for k, (i, v) in enumerate(zip(rng.permutation(10_000), x))]
    got = joined(o11.near_duplicate_vectors(vectors(spark, rows), window=4, tile=tile))
    assert got == linked(rows, 0.93) and sum(r[1] for r in got) > 1000


def test_balls_open_to_each_other(spark):
    """Two tight groups at just the threshold's angle: some of their pairs are links, some are not, and members are compared."""
    rng, angle = np.random.default_rng(5), math.acos(0.93)
    one = np.zeros((40, 8))
    one[:, 0] = 1
    two = np.tile([math.cos(angle), math.sin(angle), *[0] * 6], (40, 1))
    x = np.concatenate([one, two]) + rng.normal(0, 0.01, (80, 8))
    rows = [(i, 1, v.tolist()) for i, v in enumerate(x)]
    for tile in (512, 7):
        got = joined(o11.near_duplicate_vectors(vectors(spark, rows, "double"), tile=tile))
        assert got == linked(rows, 0.93) and {r[1] for r in got} - {39, 79}


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [1.0, 2.0]), (2, 1, [2.0, 4.0]), (3, None, [1.0, 2.0]), (4, 1, None), (5, 1, []), (6, 1, [0.0, 0.0]), (7, 1, [1.0, nan]), (8, 1, [inf, 1.0]), (9, 1, [None, 1.0])]
    rows += [(None, 1, [1.0, 2.0]), (2, 1, [2.0, 4.0]), (2, 1, [5.0, -1.0]), (10, 1, [1.0, 2.0, 0.0]), (11, 2, [1.0, 2.0]), (12, 1, [1e300, 2e300]), (13, 1, [-1e-300, -2e-300]), (14, 2, [1.0, 2.1])]
    got = joined(o11.near_duplicate_vectors(vectors(spark, rows, "double")))
    assert got == linked(rows, 0.93)
    assert joined(o11.near_duplicate_vectors(vectors(spark, [], "double"))) == []
    assert joined(o11.near_duplicate_vectors(vectors(spark, rows[3:6], "double"))) == [(4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)]


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs just above the threshold, far from all others: what the passes find of them, against brute force."""
    rng, rows = np.random.default_rng(9), []
    for k in range(600):
        a, b = rng.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        turn = math.acos(rng.uniform(0.93, 0.95))
        rows += [(2 * k, 0, a.tolist()), (2 * k + 1, 0, (math.cos(turn) * a + math.sin(turn) * b / np.linalg.norm(b)).tolist())]
    got = joined(o11.near_duplicate_vectors(vectors(spark, rows, "double")))
    recall = sum(r[1] for r in got) / sum(r[1] for r in linked(rows, 0.93))
    assert recall >= 0.98
    assert all(r[1] <= 1 for r in got)


def test_passes_grow_slowly_with_the_rows():
    assert o11.passes_for(10) == 1 and o11.passes_for(0) == 1
    n = [o11.passes_for(10**k) for k in range(2, 10)]
    assert n == sorted(n) and n[-1] < 200


def test_pipeline_judges_each_row_by_its_text(spark):
    """Clean rows stay where another row of their doc_id, or another row without one, holds a benchmark passage."""
    import corpus_pipeline

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, item), (1, "clean words"), (None, item), (None, "clean too"), (None, None), (2, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.decontamination(spark, df, SF)
    assert got.columns == df.columns and sorted((r["doc_id"], r["text"]) for r in got.where("doc_id IS NOT NULL").collect()) == [(1, "clean words"), (2, "")]
    assert sorted(repr(r["text"]) for r in got.where("doc_id IS NULL").collect()) == ["'clean too'", "None"]
