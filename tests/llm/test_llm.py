import glob
import io
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riverlog.llm import bwt, common, op1_token_output as o1, op2_decontamination as o2, op3_best_fit_packing as o3, op4_chat_format as o4, op5_topk_search as o5
from riverlog.llm import op6_language_id as o6, op7_repeated_strings as o7, op8_toxicity as o8, op9_url_filter as o9, op10_minhash_dedup as o10, queries, tokens

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n int, row string, key string, text_ string"


def docs(spark, texts, more=()):
    """Rows with clashing extra columns; `more` are whole (doc_id, text) rows."""
    rows = [*enumerate(texts), *more]
    return spark.createDataFrame([(i, t, 1, "r", "k", "z") for i, t in rows], DOCS)


ODD = ["", None, "   ", "a", "word " * 30_000, "<|endoftext|> é", "same same", "same same", "!!! ???", "\u4e2d\u6587"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, want = queries.QUERIES[name](spark, SF), c.sql(queries.ORACLES[name])
    cols = sorted(want.columns)
    norm = lambda rows: sorted(repr(tuple(r)) for r in rows)
    assert norm(got.select(*cols).collect()) == norm(want.select(*[duckdb.ColumnExpression(x) for x in cols]).fetchall())


def test_bits():
    for bits in (1, 5, 8, 13, 16, 17, 32):
        ids = np.random.default_rng(bits).integers(0, 1 << min(bits, 31), 1000).astype("<u4")
        assert (o1.unpack(o1.pack(ids, bits), bits, 1000) == ids).all()
    out = io.BytesIO()
    w = o1.ShardWriter(out, 16, 64)
    parts = [np.arange(n, dtype="<u4") for n in (0, 1, 200, 63, 64, 5)]
    for i, p in enumerate(parts):
        w.add(i, p)
    w.close()
    with pytest.raises(ValueError):
        w.add(None, parts[0])
    r = o1.ShardReader(out)
    assert all((r.document(i) == p).all() for i, p in enumerate(parts)) and (r.tokens(10, 150) == np.concatenate(parts)[10:150]).all()
    with pytest.raises(ValueError):
        o1.ShardReader(io.BytesIO(out.getvalue()[:-3]))


def test_tokens_and_packing(spark):
    t = tokens.WordEncoder(tokens.default_vocabulary())
    df = docs(spark, ODD, [(None, "null id"), (3, "a")])
    want = {}
    ids = lambda x: (t._library([x])[0] if x else b"") + (1).to_bytes(4, "little")
    for i, x in enumerate(ODD):
        want[i] = zlib.crc32(ids(x))
    got = o1.digest(o1.read_tokens(o1.write_tokens(df, common.scratch(spark, "t"), tokens.default_vocabulary(), shard_docs=4))).orderBy("start").collect()
    assert len(got) == len(ODD) + 2 and all(r["ids_crc32"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert [r["doc_id"] for r in got] == [None, *sorted(r["doc_id"] for r in got[1:])] and got[0]["ids_crc32"] == zlib.crc32(ids("null id")) and all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    packed = o3.pack(df, tokens.default_vocabulary(), region_pieces=5).collect()
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(r["length"] for r in packed) == sum(r["n_tokens"] for r in got)
    assert o3.pack(df.limit(0), tokens.default_vocabulary()).count() == 0
    assert o1.read_tokens(o1.write_tokens(df.limit(0), common.scratch(spark, "t"), tokens.default_vocabulary())).count() == 0


def test_words_are_cached_within_bounds():
    """Whole texts through a small cache and small parts, against the library."""
    t = tokens.WordEncoder(tokens.default_vocabulary(), 20)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["ab", "c", "É", "ß", "9", "'s", ".", "!?", "\u4e2d", " ", " ", "\n", "\u00a0"]) for _ in range(rng.randint(0, 80))) for _ in range(300)] + [None, "x<|y|> z", "one two " * 60]
    part, tokens.PART_CHARS = tokens.PART_CHARS, 100
    try:
        assert t.encode_all(texts) == [t._library([x])[0] if x else b"" for x in texts]
    finally:
        tokens.PART_CHARS = part
    assert len(t.words) <= 20 + 100


def whole_table(spark, path):
    """Every document's ids from the library itself, in ascending doc_id order."""
    t, out = tokens.WordEncoder(tokens.default_vocabulary()), {}
    for r in spark.read.parquet(path).select("doc_id", "text").orderBy("doc_id").collect():
        out[r["doc_id"]] = (t._library([r["text"]])[0] if r["text"] else b"") + (1).to_bytes(4, "little")
    return out


def test_token_files_and_packing_of_a_whole_table(spark):
    want, at = whole_table(spark, f"{SF}/documents.parquet"), 0
    got = {r["doc_id"]: r for r in o1.op1_token_output(spark, SF).collect()}
    assert len(got) == len(want)
    for i, raw in want.items():
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(raw) // 4, zlib.crc32(raw))
        at += len(raw) // 4
    pieces, sequences = {}, {}
    for r in o3.op3_best_fit_packing(spark, SF).collect():
        assert pieces.setdefault((r["doc_id"], r["piece"]), r) is r
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    cut = {(i, k): raw[16384 * k : 16384 * (k + 1)] for i, raw in want.items() for k in range(-(-len(raw) // 16384))}
    assert {k: (r["start"], r["length"], r["ids_crc32"]) for k, r in pieces.items()} == {k: (4096 * k[1], len(x) // 4, zlib.crc32(x)) for k, x in cut.items()}
    for places in map(sorted, sequences.values()):
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096
    least = -(-at // 4096)
    assert least <= len(sequences) <= least + 1


def test_genetic_packing_reaches_the_bound():
    rng = np.random.default_rng(5)
    cut = [np.diff([0, *sorted(rng.choice(np.arange(1, 100), 3, replace=False)), 100]) for _ in range(40)]
    lengths = rng.permutation(np.concatenate(cut))
    start = o3.fitness(lengths, o3.evolve(lengths, [], 1, 100, generations=0)[0], 100)[0]
    best = o3.evolve(lengths, [], 1, 100, generations=10)[0]
    assert np.bincount(best, lengths).max() <= 100 and 40 <= o3.fitness(lengths, best, 100)[0] <= start


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_repeated_strings_made_to_cancel(spark):
    """Two different texts whose polynomials modulo 2 ** 64 agree at every base: two blocks in Thue-Morse order, and exchanged."""
    head = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(144))
    for one, two in (("eiso", "oyrx"), ("aaaa", "aaab")):
        texts = [head + "".join((one, two)[x ^ y] for x in thue_morse(64)) for y in (0, 1)]
        got = o7.remove_repeats(docs(spark, texts)).collect()
        assert [bytes(r["kept"]) for r in sorted(got, key=lambda r: r["doc_id"])] == o7.plain([t.encode() for t in texts]) == [t.encode() for t in texts]


def test_window_hashes_are_the_polynomial(monkeypatch):
    rng, base = np.random.default_rng(6), o7.new_base()
    parts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (5, 9, 6, 20, 5)] + [b"\xff" * 12, b"\x00" * 12]
    monkeypatch.setattr(o7, "HASHED", 30)
    o7._PRIME_POWERS.clear()
    got = o7.window_hashes(parts, [0] * len(parts), base, 5)
    o7._PRIME_POWERS.clear()
    for part, hashed in zip(parts, got):
        exact = [sum((b + 1) * pow(base, j + 30, o7.PRIME) for j, b in enumerate(part[i : i + 5])) % o7.PRIME for i in range(len(part) - 4)]
        with np.errstate(over="ignore"):
            assert (o7._mix(np.array(exact, np.uint64) + (-np.arange(len(exact))).astype(np.uint64)).view(np.int64) == hashed).all()
    x = rng.integers(0, o7.PRIME, 1000, dtype=np.uint64)
    assert [int(v) for v in o7._times(x, x[::-1])] == [int(a) * int(b) % o7.PRIME for a, b in zip(x, x[::-1])]
    assert [int(v) for v in o7._times(np.array([o7.PRIME - 1], np.uint64), np.array([o7.PRIME - 1], np.uint64))] == [1]


def test_decontamination_edges(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    df = docs(spark, [*ODD, "x " * 40 + passage + " y" * 40, passage[:40], "Short ITEM", "p q " + passage[3:]])
    items = spark.createDataFrame([(1, passage, "a"), (2, None, "a"), (3, "short item", "a"), (1, passage, "a"), (10, "same", "a")], "item_id long, text string, dw string")
    for limit in (o2.BROADCAST_BYTES, 0):
        got = {r["doc_id"]: r for r in o2.decontaminate(df, items, limit).collect()}
        n = len(ODD)
        assert got[n]["n_hit"] == 20 and got[n]["item_ids"] == ["1"] and got[n]["contaminated"] and got[n + 1]["n_hit"] == 0
        assert got[n + 2]["item_ids"] == ["3"] and got[n + 3]["n_hit"] == 19 and got[6]["n_hit"] == 2 and got[1]["n_words"] == 0
        assert len(got) == n + 4
    assert o2.decontaminate(df, items.limit(0)).where("n_hit > 0").count() == 0 and o2.decontaminate(df.limit(0), items).count() == 0


def test_decontamination_by_items_without_id(spark, tmp_path, monkeypatch):
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    spark.createDataFrame([(1, f"p {a} q"), (2, b), (3, "x " * 30), (4, f"{b} {a}"), (5, "tiny bit")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, a), (None, b), (None, b), (7, a), (None, "tiny bit"), (7, "other text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(c.sql(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({o2.ORACLE})").fetchall())
    real = o2.decontaminate
    for limit in (o2.BROADCAST_BYTES, 0):
        monkeypatch.setattr(o2, "decontaminate", lambda d, i, n=limit: real(d, i, n))
        assert sorted(map(tuple, o2.op2_decontamination(spark, str(tmp_path)).collect())) == want
        got = {r["doc_id"]: r["item_ids"] for r in o2.decontaminate(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet")).collect()}
        assert got == {1: ["7", None], 2: [None], 3: [], 4: ["7", None], 5: [None]}


def test_chat_edges(spark):
    rows = [(1, 0, "user", "a<|b\\"), (1, 1, "user", "|x\\\\<|<\\|"), (1, 2, "assistant", "<"), (1, 2, "assistant", None), (1, 2, "assistant", "<"), (2, None, None, ""), (None, 0, "assistant", "z<|end|>\n")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, blocks string")
    got = {r["conv_id"]: r for r in o4.read_chats(o4.format_chats(df)).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "a<|b\\"), ("user", "|x\\\\<|<\\|"), ("assistant", ""), ("assistant", "<"), ("assistant", "<")]
    assert got[1]["loss"] == ["", "<", "<"] and got[None]["loss"] == ["z<|end|>\n"] and got[2]["formatted"].count("<|turn|>") == 1
    assert o4.format_chats(df.limit(0)).count() == 0


def test_search_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)] + [(301, None), (302, [1.0, float("nan")] * 3), (303, [None] * 6), (40, [1.0] * 6), (400, [2.0] * 3), (420, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, row int")
    got = [tuple(r) for r in o5.top_k(df, F.col("vec_id") % 20 == 0, 5, shard_rows=64).collect()]
    fine = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    want = []
    for k, (i, v) in enumerate(fine):
        if i % 20 == 0:
            s = sorted((-int(v @ w), j) for m, (j, w) in enumerate(fine) if m != k and len(w) == len(v))[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    assert sorted(got) == sorted(want)
    assert o5.top_k(df.limit(0), F.lit(True)).count() == 0


def test_search_among_cells(spark):
    """Clusters, a third of all rows alike, negative and rare dimensions: many cells, of which a query reaches few."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6)) * 4
    v = np.concatenate([c + rng.normal(size=(60, 6)) * 0.1 for c in centres] + [np.tile(centres[3], (360, 1))]).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(2000 + i, [float(i % 7), -1.0]) for i in range(80)]
    got = o5.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), F.col("vec_id") % 20 == 0, 5, shard_rows=48)
    fine = [(i, np.floor(64 * np.array(x, np.float32).astype(float)).astype(int)) for i, x in rows]
    want = []
    for i, x in fine:
        if i % 20 == 0:
            s = sorted((-int(x @ w), j) for j, w in fine if j != i and len(w) == len(x))[:5]
            want += [(i, r + 1, j, -y) for r, (y, j) in enumerate(s)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    points = np.floor(64 * v.astype(float)).astype(np.int64)
    cells = o5.cell_of(points, o5.build_splits(points, 16))
    lo, hi = (np.stack([f(points[cells == c], 0) for c in np.unique(cells)]) for f in (np.min, np.max))
    scores = points @ points.T
    near = o5.reached({"points": points, "tau": np.sort(scores, 1)[:, -6].astype(float)}, lo, hi)
    assert len(lo) > 8 and near.mean() < 0.5 and near[np.arange(len(points))[:, None], np.searchsorted(np.unique(cells), cells[np.argsort(-scores, 1)[:, :5]])].all()


def test_language(spark):
    got = o6.op6_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    one = {r["doc_id"]: r for r in o6.identify(docs(spark, ODD), {"a": b"the " * 50, "b": b"der " * 50}).collect()}
    assert all(one[i]["lang_pred"] == "und" and one[i]["rejected"] for i in (0, 1, 2, 8)) and one[6]["lang_pred"] in "ab" and len(one) == len(ODD)
    assert o6.train(docs(spark, ODD).withColumn("lang", F.lit(None).cast("string"))) == {}
    assert o6.identify(docs(spark, ["abc"]), {}).first()["lang_pred"] == "und"


def test_repeats_equal_brute_force(spark, monkeypatch):
    random.seed(3)
    word = lambda: "".join(random.choice("abé") for _ in range(random.randint(1, 4)))
    pool = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = []
    for _ in range(40):
        t = ""
        for _ in range(random.randint(0, 4)):
            p = random.choice(pool)
            a = random.randint(0, len(p))
            t += p[a : random.randint(a, len(p))] + word()
        texts.append(t)
    texts += ["a" * 500, "ab" * 300, *ODD[:4], texts[0], texts[0]]
    real = o7.repeated_spans
    for length, kinds in ((40, 4096), (40, 1), (17, 4096)):
        monkeypatch.setattr(o7, "repeated_spans", lambda d, n, k=kinds: real(d, n, k))
        got = {r["doc_id"]: bytes(r["kept"]) for r in o7.remove_repeats(docs(spark, texts).repartition(3), length).collect()}
        assert [got[i] for i in range(len(texts))] == o7.plain([(t or "").encode() for t in texts], length)
    monkeypatch.setattr(o7, "BLOCK", 300)
    o7._POWERS.clear()
    left = b"".join(np.concatenate([np.arange(a, b + 1) for a, b, *_ in zip(*(np.concatenate(x) for x in zip(*o7.units(texts[40].encode() * 3, 40))))]).astype("<i8").tobytes() for _ in (0,))
    assert (np.frombuffer(left, "<i8") == np.arange(1500 - 39)).all()
    o7._POWERS.clear()
    assert o7.remove_repeats(docs(spark, ["x"]).limit(0)).count() == 0


def test_bwt_merge():
    texts = [b"banana", b"bandana", b"", b"ananas"]
    both, inter, common_ = bwt.merge(bwt.bwt(texts[:2]), bwt.bwt(texts[2:]))
    assert sorted(both) == sorted(np.concatenate([bwt.bwt(texts[:2]), bwt.bwt(texts[2:])]))
    assert (both == bwt.bwt(texts)).all() and common_.max() >= len("anana")


def test_toxicity(spark):
    got = o8.op8_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    assert ((got.predicted == got.toxic).mean()) > 0.93
    model = {"bias": -8.0, "weights": {"bad": 12.0}}
    out = {r["doc_id"]: r for r in o8.score(docs(spark, [*ODD, "Fine day. So bad! End."]), model).collect()}
    assert out[len(ODD)]["worst"] == ["So bad!"] and out[len(ODD)]["score"] > 0.9 and out[0]["score"] == out[1]["score"] == 0.0 and len(out) == len(ODD) + 1
    assert o8.train(docs(spark, ODD).withColumn("toxic", F.lit(0)))["weights"] == {}


def test_urls(spark):
    rows = [(1, "http://Good.org/x", None), (2, "http://a.com/fr/x", "<a href='http://b.net/'>"), (3, "http://b.net/q?x", ""), (4, "http://spam.com/de/1", ""), (5, "http://c.net/", '<a href="http://spam.com/de/2">'), (6, None, None), (7, "nothing", ""), (8, "x://example.org/en/12#f", ""), (9, "https://m.example.org/es/", ""), (3, "http://b.net/q?x", "")]
    got = {r["page_id"]: r for r in o9.filter_urls(spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string"), o9.RULES).collect()}
    assert [got[i]["verdict"] for i in range(1, 10)] == ["allow", "allow", "allow", "block", "block", "allow", "allow", "block", "block"]
    assert got[1]["host"] == "good.org" and got[8]["rule"] == "example.org/en/1" and got[3]["rule"] is None and got[3]["trust"] > 0 and got[6]["host"] == got[7]["path"] == ""


def test_urls_of_hubs_repeats_and_nothing(spark):
    """A hub that links everywhere and back, hosts without links out, repeated pages, and an empty table, against a dense solve."""
    hosts = ["hub.net", "a.com", "spam.com", *(f"s{i}.net" for i in range(8))]
    to = {"hub.net": hosts[1:], "a.com": ["hub.net"], "spam.com": ["hub.net", "s0.net"], "s0.net": ["spam.com"], "s1.net": ["spam.com", "hub.net"]}
    path = {"a.com": "/fr/", "spam.com": "/de/"}
    rows = [(i, f"http://{h}{path.get(h, '/x')}", "".join(f'<a href="//{t}/">' for t in to.get(h, ()))) for i, h in enumerate(hosts)]
    rows.append(rows[2])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["host"]: r for r in o9.filter_urls(df, o9.RULES).collect()}
    pages = {h: 2.0 if h == "spam.com" else 1.0 for h in hosts}
    link = np.array([[pages[a] * (b in to.get(a, ())) for b in hosts] for a in hosts])
    share = lambda m: np.divide(m, m.sum(1, keepdims=True), out=np.zeros_like(m), where=m.sum(1, keepdims=True) > 0)
    for kind, m, seed in (("trust", share(link), "a.com"), ("distrust", share(link.T), "spam.com")):
        want = np.linalg.solve(np.eye(len(hosts)) - o9.DAMPING * m.T, (1 - o9.DAMPING) * np.array([pages[h] * (h == seed) for h in hosts]))
        assert all(np.isclose(got[h][kind], x, rtol=1e-6, atol=1e-12) for h, x in zip(hosts, want))
    assert o9.filter_urls(df, o9.RULES).count() == len(rows) and o9.filter_urls(df.limit(0), o9.RULES).count() == 0


def test_repeats_of_400_bytes(spark):
    """At the operator's own length: a passage of 400 bytes goes, one of 399 stays, repeated rows and rows without an id count each."""
    rng = random.Random(9)
    fresh = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p, q, twice = fresh(400), fresh(399), fresh(450)
    rows = [(1, fresh(300) + p + fresh(90)), (2, p + fresh(700)), (3, "1" + q + "2" + fresh(50)), (4, fresh(50) + "3" + q + "4"), (5, twice), (5, twice), (None, fresh(500)), (6, None), (7, fresh(800) + p + fresh(10) + p)]
    got = o7.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = o7.plain([(t or "").encode() for _, t in rows], 400)
    assert sorted((str(r["doc_id"]), bytes(r["kept"])) for r in got) == sorted((str(i), x) for (i, _), x in zip(rows, left))
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 400, 2: 400, 3: 0, 4: 0, 5: 450, None: 0, 6: 0, 7: 800}


def test_links_without_scheme(spark):
    html = """<a href="//B.net/x?u=http://no.net/"><a HREF='//b.net'><a href=//c.net#y><a href="https://b.net/z"><a href="/no/x"><a href="no//x"><a href="mailto:a@b"><a href="//a.com/own">"""
    pages = spark.createDataFrame([(1, "http://a.com/fr/", html), (2, "http://b.net/", None)], "page_id long, url string, html string")
    assert sorted(map(tuple, o9.host_edges(pages).collect())) == [("a.com", "b.net", 3.0), ("a.com", "c.net", 1.0)]


def test_url_scores_settle(spark):
    """A chain of hosts whose last is blocked, with a trusted branch into it, against a dense solve."""
    n = 24
    to = {f"h{i}.net": [f"h{i + 1}.net"] for i in range(n - 2)} | {f"h{n - 2}.net": ["spam.com"], "a.com": ["b.net"], "b.net": ["c.net", "h3.net"], "c.net": [], "spam.com": []}
    path = {"a.com": "/fr/", "spam.com": "/de/"}
    rows = [(i, f"http://{h}{path.get(h, '/x')}", "".join(f'<a href="http://{t}/">' for t in ts)) for i, (h, ts) in enumerate(to.items())]
    got = {r["host"]: r for r in o9.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), o9.RULES).collect()}
    hosts = list(to)
    link = np.array([[float(b in to[a]) for b in hosts] for a in hosts])
    ahead, back = (m / np.maximum(1, m.sum(1, keepdims=True)) for m in (link, link.T))
    want = {k: np.linalg.solve(np.eye(len(hosts)) - o9.DAMPING * m.T, (1 - o9.DAMPING) * np.array([float(h == seed) for h in hosts])) for k, m, seed in (("trust", ahead, "a.com"), ("distrust", back, "spam.com"))}
    for i, h in enumerate(hosts):
        assert all(np.isclose(got[h][k], want[k][i], rtol=1e-6, atol=0) for k in want)
        assert got[h]["verdict"] == ("allow" if h == "a.com" or h != "spam.com" and want["distrust"][i] <= want["trust"][i] else "block")
    assert all(got[h]["verdict"] == "block" for h in ("h0.net", "h1.net", "h2.net", f"h{n - 2}.net"))


def test_near_duplicates_edges(spark):
    base = [f"w{i}" for i in range(60)]
    changed = [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in (3, 30, 55)]
    df = docs(spark, [*ODD, " ".join(base), *changed, " ".join(base[30:] + base[:30])], [(None, "null id here"), (5, "<|endoftext|> é")])
    got = {}
    for r in o10.near_duplicates(df).collect():
        got.setdefault(r["doc_id"], r)
    texts = {i: t for i, t in enumerate([*ODD, " ".join(base), *changed, " ".join(base[30:] + base[:30])])}
    sets = {i: set(o10.shingle_set((t or "").encode()).tolist()) for i, t in texts.items()}
    comp = {i: i for i in texts}
    for _ in texts:
        for i in texts:
            for j in texts:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert {i: got[i]["component_id"] for i in texts} == comp and got[None]["kept"]
    assert o10.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """A doc_id with several texts links all of them, whichever classes they belong to."""
    a, b, c = ("one two three four five six", "red green blue white black brown", "far away texts stay alone here")
    rows = spark.createDataFrame([(3, a), (7, a), (7, b), (9, b), (7, b), (7, ""), (None, a), (11, c), (11, c), (12, c), (2, "no link to them at all")], "doc_id long, text string")
    got = [tuple(r) for r in o10.near_duplicates(rows).collect()]
    want = [(3, 2, 3, True), (7, 2, 3, False), (7, 2, 3, False), (9, 2, 3, False), (7, 2, 3, False), (7, 0, 7, True), (None, 2, None, True), (11, 2, 11, True), (11, 2, 11, True), (12, 2, 11, False), (2, 2, 2, True)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_stages_with_clashing_columns_nulls_and_no_rows(spark):
    """Columns named as the operators' own, rows that repeat, rows without id, text or language, and empty tables."""
    import corpus_pipeline

    named = ["rejected", "score", "margin", "lang_pred", "kept", "n_removed", "n_bytes", "n_spans", "h", "raw", "k0", "gone_id", "bad_id", "rep", "comp", "row", "dw", "a.b", "column_1"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or "")) for i, t in enumerate([*ODD, ODD[4], "plain words in a row that mean nothing " * 3])]
    rows += [(None, "no id here but words enough to tell", "en", None, None), (0, None, None, None, None), (12, rows[-1][1], None, None, 1)]
    df = spark.createDataFrame([(*r, *["x"] * len(named)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in named))
    for rows_ in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = common.stored(stage(spark, rows_, SF), name)
            if name != "best_fit_packing":
                assert out.columns == df.columns and out.schema["text"] == df.schema["text"]
                assert all(r["a.b"] == "x" and r["kept"] == "x" for r in out.collect())
            assert rows_ is df or out.count() == 0
    left = [tuple(r[:2]) for r in corpus_pipeline.near_dedup(spark, df, SF).collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, [r[:2] for r in rows if r[0] not in (7, 10, 12)]))


def test_pipeline_stages(spark):
    import corpus_pipeline

    first = spark.read.parquet(f"{SF}/documents.parquet")
    rows, columns = first, first.columns
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, rows, SF), name)
        if name != "best_fit_packing":
            assert out.columns == columns and 0 < out.count() <= rows.count()
        rows = out if name != "best_fit_packing" else rows
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in rows.select("doc_id").collect()}


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage's rows on the rows before it, all columns, and run() as a whole."""
    import corpus_pipeline

    c = duckdb.connect()
    rows = c.sql(f"SELECT * FROM '{SF}/documents.parquet' WHERE doc_id < 60 ORDER BY doc_id").fetchall()
    items = c.sql(f"SELECT text FROM '{SF}/benchmark.parquet' ORDER BY item_id LIMIT 5").fetchall()
    texts = [r[1] for r in rows if r[1] and len(r[1]) > 1500]
    near = texts[0].split(" ")
    near[7] = "changed"
    planted = ["", None, "!!! 12 ???", texts[0], " ".join(near), texts[1][:700] + " " + texts[2][-600:], items[0][0], items[1][0] + " and so it ends", texts[3] + items[2][0][: len(items[2][0]) // 2]]
    rows += [(1000 + i, t, "en", "src0", len(t or "")) for i, t in enumerate(planted)]
    first = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    first.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    passages = [o2_words(t) for (t,) in c.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]

    def language(docs, df):
        known = o6.train(df.where(~o6.held_out(F.col("doc_id"))))
        bad = {r["doc_id"] for r in o6.identify(df, known).where("rejected").collect()}
        assert {1000, 1001, 1002} <= bad
        return {i: d for i, d in docs.items() if i not in bad}

    def components(docs, _):
        sets, comp = {i: set(o10.shingle_set((d["text"] or "").encode()).tolist()) for i, d in docs.items()}, {i: i for i in docs}
        links = [(i, j) for i in docs for j in docs if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        for _ in docs:
            for i, j in links:
                comp[i] = comp[j] = min(comp[i], comp[j])
        return {i: d for i, d in docs.items() if comp[i] == i}

    def repeats(docs, _):
        kept = [x.decode("utf-8", "ignore") for x in o7.plain([(d["text"] or "").encode() for d in docs.values()], 400)]
        return {i: d | {"text": x, "n_chars": len(x)} for (i, d), x in zip(docs.items(), kept)}

    def clean(docs, _):
        out = {}
        for i, d in docs.items():
            w, hit = o2_words(d["text"]), set()
            for item in passages:
                n = min(13, len(item))
                runs = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
                hit |= {p + k for p in range(len(w) - n + 1) if tuple(w[p : p + n]) in runs for k in range(n)}
            if not hit or 20 * len(hit) < len(w):
                out[i] = d
        return out

    brute = {"language_id": language, "minhash_near_dedup": components, "suffix_array_dedup": repeats, "benchmark_decontamination": clean}
    of = lambda df: {r["doc_id"]: r.asDict() for r in df.orderBy("doc_id").collect()}
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, after = of(df), common.stored(stage(spark, df, str(tmp_path)), name)
        want = brute[name](docs, df)
        assert of(after) == want and after.count() == len(want) and want != docs, name
        df = after
    encoder = tokens.WordEncoder(tokens.default_vocabulary())
    want = {i: (len(encoder._library([d["text"]])[0]) // 4 if d["text"] else 0) + 1 for i, d in of(df).items()}
    for packed in (corpus_pipeline.packing(spark, df, str(tmp_path)).collect(), corpus_pipeline.run(spark, str(tmp_path)).collect()):
        lengths, sequences = dict.fromkeys(want, 0), {}
        for r in packed:
            lengths[r["doc_id"]] += r["length"]
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert lengths == want
        for places in map(sorted, sequences.values()):
            assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096


def o2_words(text):
    return re.findall(r"[^\x00-\x2f:-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_toxicity_joined_training(spark):
    texts = [f"you are {'awful trash' if i % 3 == 0 else 'kind and fine'} number {i}" for i in range(60)]
    rows = docs(spark, texts, [(None, "no id"), (70, None)])
    labels = spark.createDataFrame([*((i, int(i % 3 == 0)) for i in range(60)), (70, 0), (99, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    want = o8.train(rows.join(labels, "doc_id"))
    assert want["weights"] and o8.train_joined(rows, labels) == want
    assert o8.train_joined(rows.limit(0), labels)["weights"] == {}
    assert o8.train_joined(rows, labels.limit(0))["weights"] == {}


def test_toxicity_without_telling_features(spark):
    for texts, labels in ((["same words here"] * 8, [0, 1] * 4), (["", None] * 4, [0, 1] * 4), (["a"], [1])):
        rows = spark.createDataFrame([(i if i else None, t, y) for i, (t, y) in enumerate(zip(texts, labels))], "doc_id long, text string, toxic int")
        model = o8.train(rows)
        assert model["weights"] == {} and all(0 <= r["score"] <= 1 for r in o8.score(rows, model).collect())
    assert o8.score(rows.limit(0), model).count() == 0
    twice = spark.createDataFrame([(1, "awful"), (1, "awful"), (1, "other"), (2, "fine")], "doc_id long, text string")
    assert len(o8.train_joined(twice, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))["weights"]) == 0


def test_odd_sketch_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for n, k in [(1, 0), (5, 5), (150, 25), (150, 40), (3000, 500)]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[k:], rng.integers(0, 1 << 63, k, dtype=np.uint64)]))
        differ = len(np.setxor1d(a, b))
        bits = np.bitwise_count((o10.odd_sketch(a) ^ o10.odd_sketch(b)).view(np.uint64)).sum()
        assert bits <= differ and (n > 200 or bits >= 0.85 * differ)
    assert (o10.odd_sketch(np.zeros(0, np.uint64)) == 0).all()


def test_near_duplicates_among_look_alikes(spark):
    """A group whose members mostly are no links of each other, and texts fetched by the filter of ids."""
    rng, base = np.random.default_rng(5), [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(120, rng.integers(0, 10), replace=False):
            words[k] = f"x{i}-{k}"
        texts.append(" ".join(words))
    sets = [set(o10.shingle_set(t.encode()).tolist()) for t in texts]
    comp = list(range(len(texts)))
    moved = True
    while moved:
        moved = False
        for i in range(len(texts)):
            for j in range(i):
                c = len(sets[i] & sets[j])
                if comp[i] != comp[j] and 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    moved = True
    got = {r["doc_id"]: r["component_id"] for r in o10.near_duplicates(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == comp and 1 < len(set(comp)) < 150


def test_repeated_passages_of_words(spark, monkeypatch):
    """Runs of over 50 words in fewer than 400 bytes, whatever spaces part them; against a look at every run. One of 50 words stays."""
    rng = random.Random(11)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    p, q, r = fresh(51), fresh(50), fresh(70)
    assert max(len(x.encode()) for x in (p, q)) < 400
    texts = [fresh(20) + " " + p + "\n" + fresh(9), p.replace(" ", "\n", 7) + "  end", "a " + q + " b", "c " + q + " d", fresh(3) + " " + r + " " + fresh(60) + " " + " ".join(r.split()[:60]), fresh(400), "", None, fresh(90) + "　" + fresh(2)]
    rows = docs(spark, texts)
    words, seen = [(t or "").split(" ") if "\n" not in (t or "") else re.split("[ \n]+", t) for t in texts], {}
    for k, w in enumerate(words):
        for i in range(len(w) - 50):
            seen.setdefault(tuple(w[i : i + 51]), []).append((k, i))
    gone = {(k, i + j) for at in seen.values() if len(at) > 1 for k, i in at for j in range(51)}
    want = [[x for i, x in enumerate(w) if (k, i) not in gone and x] for k, w in enumerate(words)]
    for width, limit in ((common.WORD_BYTES, o7.CODES), (30, 5)):
        monkeypatch.setattr(o7, "WORD_BYTES", width)
        monkeypatch.setattr(o7, "CODES", limit)
        codes = o7.Codes(b"k")
        assert all(o7.word_codes((t or "").encode(), codes) == b"".join(codes[x] for x in (t or "").encode().split()) for t in texts)
    got = {r["doc_id"]: r for r in o7.remove_repeats(rows.repartition(3), as_text=True, words=51).collect()}
    assert [[x for x in re.split("[ \n]+", got[i]["kept"]) if x] for i in range(len(texts))] == want
    assert got[2]["kept"] == texts[2] and got[1]["kept"] == "  end" and len(want[4]) == 3 + 10 + 60 and got[5]["kept"] == texts[5]
    assert {r["doc_id"]: r["n_removed"] for r in o7.remove_repeats(rows).collect()}[1] == 0


def test_tables_of_a_search_go(spark):
    """What op7 and the pipeline's stages store on the way is deleted when they return."""
    import corpus_pipeline
    from riverlog.sources import folders

    at = folders.shared_dir(spark).removeprefix("file://")
    rows, before = spark.read.parquet(f"{SF}/documents.parquet"), set(os.listdir(at))
    setting = spark.conf.get(common.SHUFFLES_END, None)
    out = [o7.remove_repeats(rows), corpus_pipeline.near_dedup(spark, rows, SF), corpus_pipeline.repeated_strings(spark, rows, SF)]
    assert sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(at)) - before) == ["gone", "spans", "spans"]
    assert all(df.count() for df in out) and spark.conf.get(common.SHUFFLES_END, None) == setting
