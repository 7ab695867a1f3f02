"""Logs, streams, containers, frames, held boxes and manifests."""

import glob
import io
import json
import os
import pickle
import struct
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riverlog.functions import video, wire
from riverlog.operators import boxes, detect, intervals, joins, mosaic, reports
from riverlog.plans import catalog, media
from riverlog.sources import files, mcap, mcap_source
from riverlog.streaming import sessions as streaming

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(media.ORACLES))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, want = media.QUERIES[name](spark, SF), c.sql(media.ORACLES[name])
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    norm = lambda rows: sorted(repr(tuple(r)) for r in rows)
    assert norm(got.select(*cols).collect()) == norm(want.select(*[duckdb.ColumnExpression(x) for x in cols]).fetchall())


# Joins and windows


def test_asof_ties_both_ways(spark):
    rng = np.random.default_rng(4)
    probes, stands = ([(int(g), int(t)) for g, t in zip(rng.integers(0, 4, n), rng.integers(0, 60, n))] for n in (300, 60))
    left = spark.createDataFrame([(g, t, i) for i, (g, t) in enumerate(probes)], "g long, t long, i long")
    right = spark.createDataFrame([(g, t, t) for g, t in {x for x in stands if x[0]}], "g long, t long, v long")
    for forward in (False, True):
        got = {r["i"]: r["v"] for r in joins.asof(left, right, ["g"], "t", "v", "v", forward=forward).collect()}
        for i, (g, t) in enumerate(probes):
            fits = [s for h, s in stands if h == g and g and (s >= t if forward else s <= t)]
            assert got[i] == ((min if forward else max)(fits) if fits else None)


def test_asof_of_one_large_group(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("g"), (F.col("id") * 3).alias("t"), "id")
    keys = spark.range(1000).select(F.lit(1).alias("g"), (F.col("id") * 301).alias("t"), (F.col("id") * 301).alias("v"))
    began = time.time()
    got = joins.asof(rows, keys, ["g"], "t", "v", "v", forward=True).agg(F.sum(F.col("v") - F.col("t")).alias("s"), F.count("v").alias("n")).first()
    want = [-(-t // 301) * 301 - t for t in range(0, 300_000, 3) if -(-t // 301) < 1000]
    assert (got["s"], got["n"]) == (sum(want), len(want)) and time.time() - began < 60


def test_places_by_cells(spark):
    rng = np.random.default_rng(3)
    rows = [(None if rng.random() < 0.1 else "ab"[rng.integers(2)], int(t), i) for i, t in enumerate(rng.integers(-50, 50, 200))]
    df = spark.createDataFrame([r for r in rows if r[0]], "g string, t long, i long")
    want = detect.indexed(df, ["g"], ["t", "i"]).collect()
    assert sorted(map(tuple, detect.indexed_by_cells(df, ["g"], ["t", "i"], 7).collect())) == sorted(map(tuple, want))
    top = detect.head(df, ["g"], ["t", "i"], 5)
    assert sorted(map(tuple, top.collect())) == sorted(tuple(r) for r in want if r["idx"] < 5)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_small_rules(spark):
    df = spark.createDataFrame([("f", t) for t in (0, 5, 20, 22)], "file string, t long")
    assert sorted((r["a"], r["b"]) for r in intervals.sessions(df, ["file"], gap=5, hold=30).collect()) == [(0, 35), (20, 52)]
    topics = spark.createDataFrame([("wrist",), ("head",)], "topic string")
    level = lambda **k: [r[0] for r in topics.select(detect.threshold(F.col("topic"), 0.9, [("wrist", 0.5)], **k)).collect()]
    assert level() == [0.5, 0.5] and level(strict_default=True) == [0.5, 0.9]
    assert boxes.paint((9, 9), np.array([[5, 5, 5, 8], [7, 2, 3, 8]])).sum() == 0 and boxes.paint((9, 9), np.array([[-4, -4, 2, 2]]), ellipse=False).sum() == 4
    keys = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 3, 0), (None, 1, 0), (None, 2, 1), ("b", 1, 0)], "g string, t int, k int")
    kept = detect.from_first_keyframe(keys, ["g"], "t", F.col("k") == 1)
    assert sorted(((r["g"] or "", r["t"], r["no_keyframe"]) for r in kept.collect())) == [("", 2, False), ("a", 2, False), ("a", 3, False), ("b", 1, True)]


# Logs


def log(n=100, codec="zstd", finish=True):
    out = io.BytesIO()
    w = mcap.Writer(out, chunk_bytes=500, compression=codec)
    w.add(mcap.Schema(1, mcap_source.VIDEO, "e", b"d"))
    w.add(mcap.Channel(1, 1, "/a", "x", {"k": "v"}))
    w.add(mcap.Channel(2, 0, "/b", "x"))
    for i in range(n):
        w.add(mcap.Message(1 + i % 2, i, 1000 - i, i, bytes([i % 256]) * 20))
        if i == n // 2:
            w.copy(*mcap.put(mcap.Attachment(5, 6, "map.png", "image/png", b"\x01\x02")))
            w.copy(*mcap.put(mcap.Metadata("robot", {"name": "r1"})))
    if finish:
        w.close()
    return out.getvalue()


@pytest.mark.parametrize("codec", ["zstd", "lz4", ""])
def test_logs_in_all_codecs(spark, tmp_path, codec):
    mcap_source.register(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.mcap").write_bytes(log(codec=codec))
    (tmp_path / "in/cut.mcap").write_bytes(log(codec=codec)[:-700])
    done = {r["file"]: r for r in mcap_source.repair_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()}
    assert done["a.mcap"]["messages"] == 100 and 0 < done["cut.mcap"]["messages"] <= 100
    got = spark.read.format("mcap").load(f"{tmp_path}/in/a.mcap").orderBy("sequence").collect()
    assert [(r["sequence"], r["log_time"], r["publish_time"], bytes(r["data"]), r["topic"]) for r in got] == [(i, 1000 - i, i, bytes([i]) * 20, "/ab"[0] + "ab"[i % 2]) for i in range(100)]
    assert got[0]["schema_name"] == mcap_source.VIDEO and got[0]["metadata"] == {"k": "v"} and got[1]["schema_name"] is None


def test_records_of_all_kinds(spark, tmp_path):
    mcap_source.register(spark)
    (tmp_path / "a.mcap").write_bytes(log(10))
    read = lambda what: spark.read.format("mcap").option("records", what).load(f"{tmp_path}/a.mcap")
    rows = read("records").orderBy("ordinal").collect()
    n = {k: sum(r["kind"] == k for r in rows) for k in {r["kind"] for r in rows}}
    assert {k: n[k] for k in ("header", "schema", "channel", "message", "attachment", "metadata", "data_end")} == {"header": 1, "schema": 1, "channel": 2, "message": 10, "attachment": 1, "metadata": 1, "data_end": 1}
    one = {r["kind"]: r for r in rows}
    assert (one["attachment"]["name"], one["attachment"]["media_type"], bytes(one["attachment"]["content"]), one["attachment"]["log_time"]) == ("map.png", "image/png", b"\x01\x02", 5)
    assert one["metadata"]["metadata"] == {"name": "r1"} and {r["topic"] for r in rows if r["kind"] == "message"} == {"/a", "/b"}
    bad = mcap.MAGIC + struct.pack("<BQ", 5, 22) + struct.pack("<HIQQ", 7, 0, 0, 0)
    (tmp_path / "a.mcap").write_bytes(bad)
    with pytest.raises(Exception, match="unknown channel 7"):
        read("records").collect()
    bad = mcap.MAGIC + mcap._put(mcap.Channel(1, 9, "/x", "y"))
    (tmp_path / "a.mcap").write_bytes(bad)
    with pytest.raises(Exception, match="unknown schema 9"):
        read("records").collect()


def test_parts_of_a_log(spark, tmp_path):
    """However a log is split among tasks, each message comes once; filters and `first` hold within parts."""
    mcap_source.register(spark)
    (tmp_path / "a.mcap").write_bytes(log(300))
    (tmp_path / "b.mcap").write_bytes(log(3))
    for n in (1, 700, 1 << 20):
        got = spark.read.format("mcap").option("split_bytes", n).load(str(tmp_path))
        assert sorted((r["file"], r["sequence"]) for r in got.collect()) == [("a.mcap", i) for i in range(300)] + [("b.mcap", i) for i in range(3)]
        some = got.where(f"topic = '/a' AND log_time > 900 AND log_time < 999 AND schema_name = '{mcap_source.VIDEO}'")
        assert sorted(r["sequence"] for r in some.collect() if r["file"] == "a.mcap") == list(range(2, 100, 2))
    first = spark.read.format("mcap").option("first", 2).load(f"{tmp_path}/a.mcap").collect()
    assert sorted((r["topic"], r["log_time"]) for r in first) == [("/a", 702), ("/a", 704), ("/b", 701), ("/b", 703)]
    assert spark.read.format("mcap").option("split_bytes", 700).load(str(tmp_path)).rdd.getNumPartitions() > 3


def test_keyframes_leave_the_reader_alone(spark, tmp_path):
    mcap_source.register(spark)
    key, other = (wire.DELIMITER + b"\xf0\x00\x00\x01" + bytes([k]) for k in (0x65, 0x41))
    hevc = b"\x00\x00\x01\x26\x01"
    rows = [("/a", mcap_source.VIDEO, "protobuf", wire.encode({3: key}), 1), ("/a", mcap_source.VIDEO, "protobuf", wire.encode({3: other}), 2), ("/a", mcap_source.VIDEO, "protobuf", wire.encode({1: key}), 3), ("/b", mcap_source.VIDEO, "raw", key, 4), ("/b", mcap_source.VIDEO, "raw", b"", 5), ("/c", "imu", "raw", key, 6), ("/d", mcap_source.VIDEO, "protobuf", wire.encode({3: hevc, 4: b"h265"}), 7)]
    df = spark.createDataFrame(rows, "topic string, schema_name string, message_encoding string, data binary, log_time long")
    df.coalesce(1).write.format("mcap").mode("append").save(str(tmp_path))
    assert sorted(r["log_time"] for r in mcap_source.keyframes(spark, str(tmp_path)).collect()) == [1, 4, 7]
    assert mcap_source.keyframes(spark, str(tmp_path)).where("topic = '/b'").count() == 1
    with pytest.raises(Exception, match="by index"):
        spark.read.format("mcap").option("only", "keyframes").option("mode", "sequential").load(str(tmp_path)).collect()


def test_writer_keeps_what_is_there(spark, tmp_path):
    mcap_source.register(spark)
    rows = lambda name, t=1, s=0: spark.createDataFrame([(name, "/a", t, s)], "name string, topic string, log_time long, sequence long")
    save = lambda df, mode="append": df.write.format("mcap").option("split", "name").mode(mode).save(str(tmp_path))
    left = lambda: sorted(os.listdir(tmp_path))
    read = lambda: sorted((r["file"], r["log_time"]) for r in spark.read.format("mcap").load(str(tmp_path)).collect())
    save(rows("x"))
    with pytest.raises(Exception, match="x.mcap already"):
        save(rows("x", 2))
    assert read() == [("x.mcap", 1)] and left() == ["x.mcap"]
    save(rows("a/b"))
    save(rows("../up"))
    assert left() == ["..%2Fup.mcap", "a%2Fb.mcap", "x.mcap"] and not (tmp_path.parent / "up.mcap").exists()
    for bad in (rows("y", s=1 << 32), rows("y", t=-1), rows("y", s=-1), rows(None)):
        with pytest.raises(Exception, match="must fit 32 bits|to name its log"):
            save(bad)
    assert left() == ["..%2Fup.mcap", "a%2Fb.mcap", "x.mcap"]
    save(rows("x", 3, (1 << 32) - 1), "overwrite")
    assert read() == [("x.mcap", 3)] and left() == ["x.mcap"]
    apart = spark.createDataFrame([("p", "/a", 1), ("q", "/a", 2), ("p", "/a", 3)], "name string, topic string, log_time long").coalesce(1)
    with pytest.raises(Exception, match="not together"):
        save(apart)
    assert left() == ["x.mcap"]


def test_field_of_a_message_by_place(spark):
    a = spark.createDataFrame([("t", 0, wire.encode({1: b"one", 3: b"old"})), ("t", 1, None), ("t", 900, wire.encode({3: b"keep"}))], "topic string, k long, v binary")
    b = spark.createDataFrame([("t", 0, b"new"), ("t", 1, b"x")], "topic string, k long, v binary")
    for cell in (None, 10):
        got = {r["idx"]: (r["status"], r["v"] and wire.fields(bytes(r["v"]))) for r in detect.swap_payload(a, b, ["topic"], ["k"], "v", cell=cell, field=3).collect()}
        assert got == {0: ("swapped", {1: b"one", 3: b"new"}), 1: ("swapped", None), 2: ("missing", {3: b"keep"})}


# Streams and containers


def test_sizes_by_parameter_sets():
    for codec in ("h264", "hevc"):
        for w, h in ((2, 2), (1920, 1200), (1918, 1078), (16, 8), (4096, 2)):
            p = video.parameter_set(w, h, codec)
            assert video.frame_size(b"\x00\x00\x00\x01\x09\xf0" + p + b"\x00\x00\x01\x41x", codec) == (w, h)
            with pytest.raises(ValueError):
                video.frame_size(p[:9], codec)
    assert video.frame_size(b"") is None and video.frame_size(wire.DELIMITER + b"\xf0") is None
    # Scaling lists, a picture order of the second kind, fields, and cropping in their units.
    x = video.BitsOut().put(24, 100 << 16).number(0).number(1).number(0).number(0).put(2, 1)
    x.put(1, 1).number(16)  # the first list: a change of -8, then no more
    x.put(7, 0).number(3).number(1).put(1, 0).number(0).number(2).number(2).number(1).number(3).number(1).put(1, 0)
    x.number(119).number(33).put(1, 0).put(2, 3).put(1, 1).number(0).number(0).number(1).number(1)
    assert video.frame_size(x.put(8, 0).unit(b"\x67")) == (1920, 1088 - 8)
    x = video.BitsOut().put(24, 244 << 16).number(0).number(3).put(1, 1).number(0).number(0).put(2, 0).number(0).number(0).number(0).number(1).put(1, 0).number(1).number(1).put(2, 3).put(1, 1).number(1).number(2).number(3).number(4)
    assert video.frame_size(x.unit(b"\x27")) == (32 - 3, 32 - 7)
    x = video.BitsOut().put(8, 2 << 1).put(96, 0).put(4, 0b1101).put(12, 0).put(96, 0).put(8, 0).number(0).number(2).number(640).number(482).put(1, 1).number(1).number(1).number(0).number(2)
    assert video.frame_size(x.put(8, 0).unit(b"\x42\x01"), "hevc") == (636, 480)


class Counted(io.BytesIO):
    total = 0

    def read(self, n=-1):
        out = super().read(n)
        self.total += len(out)
        return out


def test_containers_without_their_media(spark, tmp_path):
    for turn in (0, 90, 180, 270):
        raw = files.container(1920, 1080, turn, 300, 600, 6000, media=5_000_000)
        f = Counted(raw)
        assert files.probe_container(f, len(raw)) == {"codec": "avc1", "width": 1920, "height": 1080, "rotation": turn, "frames": 300, "timescale": 600, "duration": 6000} and f.total < 1000
    (tmp_path / "ok.mp4").write_bytes(raw)
    (tmp_path / "cut.mov").write_bytes(raw[:-40])
    (tmp_path / "sound.m4v").write_bytes(raw.replace(b"vide", b"soun"))
    (tmp_path / "none.mp4").write_bytes(b"")
    (tmp_path / "still.mp4").write_bytes(files.container(2, 2, 0, 1, 600, 0))
    (tmp_path / "x.txt").write_bytes(b"x")
    got = {r["file"]: r for r in files.probe_containers(spark, str(tmp_path)).collect()}
    assert {k: r["status"].split(":")[0] for k, r in got.items()} == {"ok.mp4": "ok", "cut.mov": "broken", "sound.m4v": "no video", "none.mp4": "no video", "still.mp4": "ok"}
    assert got["ok.mp4"]["fps"] == 30.0 and got["still.mp4"]["fps"] is None


def test_digests_of_files(spark, tmp_path):
    import hashlib

    want = {}
    for name, n in (("empty", 0), ("one", 1), ("edge", files.CHUNK), ("more", 2 * files.CHUNK + 7)):
        (tmp_path / name).write_bytes(raw := np.random.default_rng(n).bytes(n))
        want[name] = (n, hashlib.sha256(raw).hexdigest())
    assert {r["file"]: (r["bytes"], r["sha256"]) for r in files.digest_files(spark, str(tmp_path)).collect()} == want
    mcap_source.register(spark)
    spark.createDataFrame([("/a", 1)], "topic string, log_time long").write.format("mcap").mode("append").save(f"{tmp_path}/logs")
    (row,) = files.digest_files(spark, f"{tmp_path}/logs", (".mcap",)).collect()
    assert row["sha256"] == hashlib.sha256((tmp_path / "logs" / row["file"]).read_bytes()).hexdigest()


# Frames


def test_coarse_masks_cover_the_fine_ones():
    rng = np.random.default_rng(7)
    for h, w in ((64, 64), (61, 47), (9, 200)):
        mask = (rng.random((h, w)) < 0.004).astype(np.uint8)
        mask[h // 3 : h // 2, w // 4 : w // 2] = 1
        for r in (3, 8, 9, 13, 20):
            fine, coarse = boxes.dilate(mask, r), boxes.dilate(mask, r, coarse=True)
            assert coarse.shape == mask.shape and (coarse >= fine).all() and (boxes.dilate(mask, -r, coarse=True) <= boxes.dilate(mask, -r)).all()
        assert (boxes.dilate(mask, 3, coarse=True) == boxes.dilate(mask, 3)).all()


def test_resized_areas():
    frame = np.random.default_rng(1).integers(0, 256, (7, 5, 3)).astype(np.uint8)
    assert np.allclose(boxes.resized(frame, 7, 5), frame) and np.allclose(boxes.resized(frame, 1, 1), frame.mean((0, 1)))
    want = np.repeat(np.repeat(frame.astype(float), 3, 0), 4, 1).reshape(3, 7, 4, 5, 3).mean((1, 3))
    assert np.allclose(boxes.resized(frame, 3, 4), want)


def test_fills_smooth_and_anonymous():
    rng = np.random.default_rng(2)
    frame, mask = rng.integers(0, 256, (50, 70, 3)).astype(np.uint8), np.zeros((50, 70), np.uint8)
    mask[10:40, 5:65] = 1
    for mode in ("grey", "pixelate", "blur", "anon"):
        out = boxes.fill(frame, mask, mode, 128, 9, (10, 200, 255))
        assert (out[mask == 0] == frame[mask == 0]).all() and (out[mask == 1] != frame[mask == 1]).any()
    flat = np.full((40, 40, 3), 77, np.uint8)
    assert (boxes.fill(flat, np.ones((40, 40)), "blur", block=7) == 77).all() and (boxes.fill(flat, np.ones((40, 40)), "pixelate", block=7) == 77).all()
    assert (boxes.fill(flat, np.ones((40, 40)), "anon", block=7, tint=(255, 0, 51)) == [90, 0, 18]).all()
    ramp = np.repeat(np.repeat(np.linspace(0, 255, 64).astype(np.uint8)[None, :, None], 64, 0), 3, 2)
    soft = boxes.fill(ramp, np.ones((64, 64)), "blur", block=8)[32, :, 0].astype(int)
    assert (np.diff(soft) >= 0).all() and np.diff(soft).max() <= 8
    with pytest.raises(ValueError):
        boxes.fill(frame, mask, "other")


def test_colours_of_frames():
    # Pure colours and their hues in half degrees: fixed values of the colour circle.
    for bgr, want in (((255, 0, 0), (120, 255, 255)), ((0, 255, 0), (60, 255, 255)), ((0, 0, 255), (0, 255, 255)), ((0, 0, 0), (0, 0, 0)), ((9, 9, 9), (0, 0, 9)), ((0, 255, 255), (30, 255, 255)), ((1, 0, 255), (0, 255, 255)), ((10, 0, 255), (179, 255, 255))):
        assert tuple(boxes.hsv(np.array([[bgr]], np.uint8))[0, 0]) == want
    blue = np.full((20, 20, 3), (255, 0, 0), np.uint8)
    outside, small = np.array([[-50.0, -50, 5, 5, 1]]), np.array([[0.0, 0, 9, 9, 1]])
    assert len(boxes.without_coloured(blue, np.array([[-5.0, 3, 90, 90, 1]]), 0.3)) == 0
    assert len(boxes.without_coloured(blue, outside, 0.3)) == len(boxes.without_coloured(blue, small, 0.3)) == 1
    assert boxes.without_coloured(blue, np.zeros((0, 5)), 0.3).shape == (0, 5)


def test_mosaics(spark):
    one = np.full((2, 2, 3), 100, np.uint8)
    rows = [(1, 0, 2, 2, one.tobytes()), (1, 2, 2, 2, None), (2, 1, 2, 2, one.tobytes())]
    df = spark.createDataFrame(rows, "tick long, slot int, height int, width int, pixels binary")
    got = {r["tick"]: np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"], 3) for r in mosaic.compose(df, ["tick"], "slot", 3, 2, (3, 5)).collect()}
    for tick, (y, x) in {1: (0, 0), 2: (0, 5)}.items():
        want = np.full((6, 10, 3), 24)
        want[y : y + 3, x : x + 5] = 100
        assert (got[tick] == want).all()
    with pytest.raises(Exception, match="slot 2 of 2"):
        mosaic.compose(df, ["tick"], "slot", 2, 2, (3, 5)).collect()


def test_detectors_live_with_their_workers(spark, tmp_path, monkeypatch):
    made = str(tmp_path)

    class Counting(detect.BrightBoxDetector):
        def __init__(self):
            open(f"{made}/{os.getpid()}-{time.time_ns()}", "w").close()

    frame = np.zeros((300, 200, 3), np.uint8)
    frame[100:150, 30:90] = 255
    rows = [(i, 300, 200, frame.tobytes()) for i in range(8)] + [(8, None, 200, b""), (9, 300, 200, None)]
    df = spark.createDataFrame(rows, "id long, height int, width int, pixels binary").repartition(8)
    for k in range(3):
        got = {r["id"]: r["boxes"] for r in detect.detect_frames(df, ["id"], Counting, per_worker=True).collect()}
        assert [tuple(x)[:4] for x in got[0]] == [(30, 100, 90, 150)] and got[8] is None and got[9] is None
    runs = [x.split("-")[0] for x in os.listdir(made)]
    assert len(runs) == len(set(runs)) <= 8  # one a worker process, over three jobs of eight tasks
    seen = []
    real = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, s, barrier=False, profile=None: seen.append(profile) or real(self, f, s))
    profile = detect.gpu_profile(2, 4)
    detect.detect_frames(df, ["id"], Counting, profile=profile)
    assert seen == [profile] and profile.taskResources["gpu"].amount == 0.25 and profile.executorResources["gpu"].amount == 2 and detect.task_device() == "cpu"


# Held boxes


def test_boxes_held_in_batch_and_stream(spark, tmp_path):
    """Three micro-batches in any order of rows: what leaves by each, and in the end what the batch operator has. Null boxes are none."""
    streaming.use_stateful_processors(spark)
    rng = np.random.default_rng(11)
    rows = [(f, i, k, None if rng.random() < 0.3 else [[float(k), 0.5]] * int(rng.integers(0, 3))) for k, (f, i) in enumerate((f, i) for f in (7, None) for i in range(40))]
    cuts = [rows[:25] + rows[40:43], rows[25:40] + rows[43:], [(99, 10**6, 10**6, [])]]
    schema, src, out, at = "f long, ts timestamp, id long, boxes array<array<double>>", *(str(tmp_path / x) for x in ("in", "out", "state"))
    counts = []
    for part in cuts:
        order = rng.permutation(len(part))
        spark.createDataFrame([part[i] for i in order], "f long, s long, id long, boxes array<array<double>>").selectExpr("f", "timestamp_seconds(1000000000 + s * 60) AS ts", "id", "boxes").coalesce(1).write.mode("append").parquet(src)
        held = streaming.hold_boxes_stream(spark.readStream.schema(schema).parquet(src), ["f"], "ts", "id", "boxes", 5, "1 hour")
        counts.append(streaming.run_once(held, out, at).count())
    assert counts[0] <= counts[1] <= counts[2] == 80
    batch = spark.createDataFrame(rows, "f long, s long, id long, boxes array<array<double>>")
    want = {r["id"]: r["b"] for r in batch.select("id", detect.hold_boxes(batch, ["f"], ["s", "id"], "boxes", 5).alias("b")).collect()}
    got = spark.read.parquet(out).collect()
    assert {r["id"]: r["boxes"] for r in got} == want and {r["f"] for r in got} == {7, None}
    plain = {k: [b for f2, j, _, x in rows if f2 == f and abs(i - j) <= 2 for b in x or []] for f, i, k, _ in rows}
    assert want == plain
    with pytest.raises(ValueError):
        detect.hold_boxes(batch, ["f"], ["s"], "boxes", 4)


def test_null_flags_do_not_end_a_stream(spark, tmp_path):
    src, out, at = (str(tmp_path / x) for x in ("in", "out", "state"))
    rows = [("a", i, i, None if i == 3 else int(i == 1)) for i in range(6)] + [("z", 10**6, 99, 0)]
    spark.createDataFrame(rows, "file string, s long, id long, flag int").selectExpr("file", "timestamp_seconds(1000000000 + s * 60) AS ts", "id", "flag").write.parquet(src)
    held = streaming.hold_stream(spark.readStream.schema("file string, ts timestamp, id long, flag int").parquet(src), ["file"], "ts", "id", "flag", 3)
    assert {r["id"]: r["held"] for r in streaming.run_once(held, out, at).where("file = 'a'").collect()} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


# Manifests


def test_records_of_manifests(spark):
    bounds = spark.createDataFrame([("f", 100), ("g", 0)], "file string, duration long")
    targets = spark.createDataFrame([("f", "clip", "f_clip01", 60, 90), ("f", "clip", "f_clip00", 0, 50), ("f", "removed", "f_removed00", 50, 60)], "file string, kind string, name string, a long, b long")
    messages = spark.createDataFrame([("f_clip00", 7)], "name string, messages long")
    got = {r["file"]: json.loads(r["j"]) for r in reports.cut_records(targets, messages, bounds, ["file"]).select("file", F.to_json(F.struct("*")).alias("j")).collect()}
    assert got["g"] == {"file": "g", "duration": 0, "kept": 0, "removed": 0, "kept_ppm": 0, "clips": [], "removed_logs": []}
    assert (got["f"]["kept"], got["f"]["removed"], got["f"]["kept_ppm"]) == (80, 10, 800_000)
    assert [(x["name"], x["duration"], x["messages"]) for x in got["f"]["clips"]] == [("f_clip00", 50, 7), ("f_clip01", 30, 0)]
    box = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
    frames = spark.createDataFrame([("f", "a", True, [(0.0, 0.0, 4.9, 2.0), (1.0, 1.0, 2.0, 9.0)]), ("f", "a", True, None), ("f", "a", False, []), ("f", "b", True, [])], f"file string, topic string, detected boolean, boxes {box}")
    (r,) = reports.blur_records(frames, ["file"]).collect()
    assert (r["frames"], r["frames_with_faces"]) == (4, 1) and tuple(r["channels"]["a"]) == (3, 2, 1, 2, 8) and tuple(r["channels"]["b"]) == (1, 1, 0, 0, 0)


def test_runs_merge_into_a_manifest(spark):
    table = lambda rows: spark.createDataFrame(rows, "file string, run int")
    records, short = reports.merged_manifest(table([("a", 1), ("b", 1)]), table([("c", 1), ("d", 1)]), table([("b", 2), ("c", 2)]), table([("a", 2)]), "file")
    assert sorted(map(tuple, records.collect())) == [("a", 1), ("b", 2), ("c", 2)] and sorted(map(tuple, short.collect())) == [("a", 2), ("d", 1)]


def test_clock_as_of(spark):
    # Inputs and results that are given, not chosen here: fixed values.
    rows = spark.createDataFrame([("f", 3, 7, 4), ("f", 3, 5, 4), ("f", 25, 8, 4), ("f", 20, 6, 4), ("f", 99, 9, 4), ("g", None, 1, 2), ("g", None, 3, 2), ("g", 11, 2, 2), ("h", None, 1, 0), ("i", 0, None, 1)], "file string, t long, v long, last long")
    got = {(r["file"], r["k"]): r["out"] for r in joins.asof_clock(rows, ["file"], "t", "v", "out", 0, 10, "last").collect()}
    assert got == {("f", 0): None, ("f", 1): 5, ("f", 2): 6, ("f", 3): 8, ("f", 4): 8, ("g", 0): None, ("g", 1): None, ("g", 2): 2, ("h", 0): None, ("i", 0): None, ("i", 1): None}
    late = {(r["file"], r["k"]): r["out"] for r in joins.asof_clock(rows.where("file = 'f'"), ["file"], "t", "v", "out", 5, 20, "last").collect()}
    assert late == {("f", 0): 5, ("f", 1): 8, ("f", 2): 8, ("f", 3): 8, ("f", 4): 8}


def test_rows_without_a_number_only_move_a_stream(spark, tmp_path):
    """Groups share their state's buckets; numbers beside nulls stay whole."""
    src, out, at = (str(tmp_path / x) for x in ("in", "out", "state"))
    big = 2**53 + 1
    rows = [("a", i, big + 2 * i, int(i == 1)) for i in range(4)] + [(None, 1, 7, 1), ("a", 2, None, 1), ("z", 10**6, None, 1)]
    spark.createDataFrame(rows, "file string, s long, id long, flag int").selectExpr("file", "timestamp_seconds(1000000000 + s * 60) AS ts", "id", "flag").write.parquet(src)
    held = streaming.hold_stream(spark.readStream.schema("file string, ts timestamp, id long, flag int").parquet(src), ["file"], "ts", "id", "flag", 3)
    assert {(r["file"], r["id"]): r["held"] for r in streaming.run_once(held, out, at).collect()} == {("a", big): 1, ("a", big + 2): 1, ("a", big + 4): 1, ("a", big + 6): 0, (None, 7): 1}


def test_few_logs_are_several_tasks(spark, tmp_path):
    mcap_source.register(spark)
    rows = spark.range(40).selectExpr("CAST(id AS STRING) AS name", "'a' AS topic", "id AS log_time", "CAST('x' AS BINARY) AS data")
    rows.repartition("name").sortWithinPartitions("name").write.format("mcap").option("split", "name").mode("append").save(str(tmp_path / "logs"))
    reader = mcap_source.McapReader({"path": str(tmp_path / "logs")})
    assert [len(p.parts) for p in reader.partitions()] == [16, 16, 8]


def test_a_log_takes_few_rows_at_a_time(monkeypatch):
    sizes, add = [], mcap_source._Log._add
    monkeypatch.setattr(mcap_source._Log, "_add", lambda self, rows: (sizes.append(rows.num_rows), add(self, rows))[1])
    log = mcap_source._Log(io.BytesIO(), "zstd")
    log.add(pa.RecordBatch.from_arrays([pa.array(["a"] * 600), pa.array(range(600))], ["topic", "log_time"]))
    assert sizes == [256, 256, 88] and sum(log.writer.counts.values()) == 600


def test_driver_knows_folders_of_logs_alone(spark, tmp_path, monkeypatch):
    """Of many logs, the commit and the read get folders from tasks and list, not each log's name."""
    mcap_source.register(spark)
    at, made = str(tmp_path / "logs"), []
    monkeypatch.setattr(mcap_source, "TaskContext", type("T", (), {"get": lambda: type("T", (), {"partitionId": lambda self: 0})()}))
    rows = lambda names: pa.RecordBatch.from_pydict({"name": names, "topic": ["/a"] * len(names), "log_time": list(range(len(names)))})
    writer = lambda at, overwrite=False, **o: mcap_source.McapWriter({"path": at, "split": "name", **o}, overwrite, ["name", "topic", "log_time"])
    w = writer(at, folders="true")
    for n in (10, 600):
        made.append(w.write(iter([rows([f"{n}_{i}" for i in range(n)])])))
    assert len(pickle.dumps(made[0])) == len(pickle.dumps(made[1])) and sorted(os.listdir(tmp_path / "logs")) == [w.aside]
    w.commit([*made, w.write(iter([rows([])]))])
    folders = sorted(os.listdir(tmp_path / "logs"))
    assert sorted(len(os.listdir(f"{at}/{x}")) for x in folders) == [10, 88, 256, 256]
    reader = mcap_source.McapReader({"path": at, "folders": "true"})
    assert [p.parts for p in reader.partitions()] == [[(f"{at}/{x}", None, None)] for x in folders]
    got = spark.read.format("mcap").option("folders", "true").load(at).select("file", "log_time").collect()
    assert sorted(map(tuple, got)) == sorted((f"{n}_{i}.mcap", i) for n in (10, 600) for i in range(n))
    w = writer(at, folders="true")
    with pytest.raises(FileExistsError, match="written once"):
        w.commit([w.write(iter([rows(["new"])]))])
    for o in ({"folders": "true"}, {}):  # one name from two tasks
        w = writer(str(tmp_path / "twice"), **o)
        with pytest.raises(ValueError, match="not together"):
            w.commit([w.write(iter([rows(["a", "x"])])), w.write(iter([rows(["x", "y"])]))])
        assert os.listdir(tmp_path / "twice") == []
    assert sorted(os.listdir(at)) == folders
    w = writer(at, True, folders="true")
    w.commit([w.write(iter([rows(["b", "a"])]))])
    assert [sorted(os.listdir(f"{at}/{x}")) for x in os.listdir(at)] == [["a.mcap", "b.mcap"]]
    none = writer(str(tmp_path / "none"), folders="true")
    none.commit([])
    for o in ({"folders": "true"}, {}):
        assert spark.read.format("mcap").options(**o).load(str(tmp_path / "none")).count() == 0


def test_names_of_logs_are_read_in_parts(tmp_path):
    names = [b"x" * (i % 50) + b"%d" % i for i in range(300)]
    (tmp_path / "names").write_bytes(b"".join(x + b"\n" for x in names))
    fs, at = mcap_source.file_system(str(tmp_path / "names"))
    assert all(list(mcap_source._lines(fs, at, n)) == names for n in (1, 7, 1 << 14))
    (tmp_path / "names").write_bytes(b"")
    assert list(mcap_source._lines(fs, at)) == []


def test_parts_of_small_logs(spark, tmp_path):
    mcap_source.register(spark)
    (tmp_path / "a.mcap").write_bytes(log(300))
    got = spark.read.format("mcap").option("split_bytes", 1500).load(str(tmp_path))
    assert sorted(r["sequence"] for r in got.collect()) == list(range(300))


def test_cut_write_makes_folders_of_logs_and_broadcasts_nothing(spark, monkeypatch):
    made, plans, scratch, stored, route = {}, [], catalog.scratch, catalog._stored, joins.route
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(catalog, "scratch", lambda s, what: made.setdefault(what, scratch(s, what)))
    monkeypatch.setattr(catalog, "_stored", lambda df, what: stored(planned(df), what))
    monkeypatch.setattr(joins, "route", lambda *a, **b: planned(route(*a, **b)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    names = catalog.cut_write(spark, SF).select("name").distinct().count()
    at = made["logs"].removeprefix("file://")
    assert len(glob.glob(f"{at}/part-*/*.mcap")) == names > 0 and not glob.glob(f"{at}/*.mcap")
    assert len(plans) == 4 and all("Join" in x and "Broadcast" not in x for x in plans)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
