"""The registered queries of the recording operators over the driver's tables, and the SQL each is compared with.

A user's events are one recording, an event type is a camera topic, value is a detection's score. Times are LONG microseconds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.functions import scalars, wire
from riverlog.operators import boxes, cut, detect, intervals, joins, manifest, reports
from riverlog.sources.folders import file_system, scratch
from riverlog.sources import mcap_source
from riverlog.streaming import sessions as streaming

HOUR = 3_600_000_000
GAP, PAD, MIN_KEEP, CONF, OVERRIDES = 6 * HOUR, HOUR, 12 * HOUR, 100.0, [("err", 150.0), ("click", 120.0)]
BY, CHANNEL = ["file"], ["file", "topic"]
LEVELS = [50.0, 100.0, 150.0, 200.0, 250.0]
SWEEP = [0, HOUR, 6 * HOUR, 12 * HOUR, 24 * HOUR, 48 * HOUR]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("file"), F.col("event_type").alias("topic"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "value")


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each recording's first time and how long it is."""
    return _events(spark, sf_dir).where("file IS NOT NULL").groupBy("file").agg(F.min("t").alias("t0"), (F.max("t") - F.min("t")).alias("duration"))


def _relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times from each recording's first event on; the starts are summed up first, so no recording is one task's."""
    e = _events(spark, sf_dir)
    return e.join(_recordings(spark, sf_dir), "file").select("event_id", "file", "topic", (F.col("t") - F.col("t0")).alias("t"), "value")


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recordings(spark, sf_dir).select("file", "duration")


def _hits(rel: DataFrame) -> DataFrame:
    return rel.where(F.col("value") >= detect.threshold(F.col("topic"), CONF, OVERRIDES))


def _drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions are made of the hits' own times and then counted from their recording's start, so only hits are sorted. The spans are
    dealt anew at the end: what follows, also by recording, is another task's and holds its own memory."""
    found = intervals.sessions(_hits(_events(spark, sf_dir)), CHANNEL, gap=GAP).join(_recordings(spark, sf_dir), "file")
    spans = found.select("file", (F.col("a") - F.col("t0")).alias("a"), (F.col("b") - F.col("t0")).alias("b"))
    return intervals.union(intervals.pad(spans, 0, PAD), BY).repartition(*BY)


def _keys(rel: DataFrame) -> DataFrame:
    """Every tenth row of a topic is a keyframe."""
    return detect.indexed(rel, CHANNEL, ["t", "event_id"]).where("idx % 10 = 1").select("file", "topic", "t")


def _keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """_keys of all recordings, stored: places are counted by the events' own times, and keyframes alone meet their recordings."""
    keys = _keys(_events(spark, sf_dir)).join(_recordings(spark, sf_dir), "file")
    return _stored(keys.select("file", "topic", (F.col("t") - F.col("t0")).alias("t")), "keyframes")


#: Common parts of the SQL.
_E = "e AS (SELECT event_id, user_id AS file, event_type AS topic, epoch_us(ts) AS t, value FROM events)"
_REL = f"{_E}, rel AS (SELECT event_id, file, topic, t - min(t) OVER (PARTITION BY file) AS t, value FROM e), bounds AS (SELECT file, max(t) AS duration FROM rel GROUP BY file)"
_HITS = f"{_REL}, hits AS (SELECT * FROM rel WHERE value >= CASE WHEN topic LIKE '%err%' THEN 150 WHEN topic LIKE '%click%' THEN 120 ELSE 100 END)"
_SESS = f"""{_HITS}, s1 AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY file, topic ORDER BY t) <= {GAP} THEN 0 ELSE 1 END AS brk FROM hits),
s2 AS (SELECT *, sum(brk) OVER (PARTITION BY file, topic ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM s1),
sess AS (SELECT file, topic, min(t) AS a, max(t) AS b, count(*) AS n FROM s2 GROUP BY file, topic, g)"""
_DROPS = f"""{_SESS}, padded AS (SELECT file, greatest(0, a - {PAD}) AS a, b + {PAD} AS b FROM sess),
u1 AS (SELECT *, max(b) OVER (PARTITION BY file ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM padded),
u2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM u1),
drops AS (SELECT file, min(a) AS a, max(b) AS b FROM u2 GROUP BY file, g)"""
_RUNS = f"""{_DROPS}, runs AS (SELECT file, coalesce(lag(b) OVER (PARTITION BY file ORDER BY a), 0) AS a, a AS b FROM drops
  UNION ALL SELECT bounds.file, coalesce(m, 0), duration FROM bounds LEFT JOIN (SELECT file, max(b) AS m FROM drops GROUP BY file) x ON x.file = bounds.file)"""
_KEEP = f"{_RUNS}, keep AS (SELECT * FROM runs WHERE b - a >= {MIN_KEEP})"
_KEYS = "ks AS (SELECT file, topic, t FROM (SELECT *, row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS idx FROM rel) WHERE idx % 10 = 1)"
_CLIPS = f"""{_KEEP}, {_KEYS}, topics AS (SELECT DISTINCT file, topic FROM ks), each AS (SELECT * FROM keep JOIN topics USING (file)),
ahead AS (SELECT each.file, a, b, k.t AS nx FROM each ASOF LEFT JOIN ks k ON k.file = each.file AND k.topic = each.topic AND k.t >= each.a),
nxt AS (SELECT file, a, b, max(coalesce(nx, b)) AS nxt, count(*) FILTER (nx IS NULL) AS topics_without FROM ahead GROUP BY file, a, b),
back AS (SELECT n.*, topic FROM nxt n JOIN topics USING (file)),
low AS (SELECT back.file, a, b, nxt, topics_without, min(coalesce(k.t, 0)) AS low FROM back ASOF LEFT JOIN ks k ON k.file = back.file AND k.topic = back.topic AND k.t <= back.nxt GROUP BY back.file, a, b, nxt, topics_without),
clips AS (SELECT * FROM (SELECT file, CASE WHEN low < a THEN nxt ELSE low END AS a, b, topics_without FROM low) WHERE b - a >= {MIN_KEEP})"""


def _stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again, where several branches of a plan would each compute it anew."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _merged(spark: SparkSession) -> Iterator[None]:
    """Joins that are computed within are merged. Spark takes a column of a table for as small as its share of the packed file, so some
    6,000,000 rows could be broadcast as one of 9 MB and fill the driver."""
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = [spark.conf.get(x, None) for x in names]
    for x in names:
        spark.conf.set(x, "-1")
    try:
        yield
    finally:
        for x, value in zip(names, before):
            spark.conf.unset(x) if value is None else spark.conf.set(x, value)


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips and removed spans with the names of their logs."""
    keys = _keyframes(spark, sf_dir)
    clips = _stored(cut.snap(_keep(spark, sf_dir), keys, BY, "topic", MIN_KEEP), "clips")
    return cut.targets(clips, cut.removed(clips, _bounds(spark, sf_dir), keys, BY, "topic", HOUR), BY, "file")


def _keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.complement(_drops(spark, sf_dir), _bounds(spark, sf_dir), BY, MIN_KEEP)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut.snap(_keep(spark, sf_dir), _keyframes(spark, sf_dir), BY, "topic", MIN_KEEP)


def threshold_by_topic(spark, sf_dir):
    return _hits(_relative(spark, sf_dir)).select("event_id", "file", "topic", "t")


def stride_sample(spark, sf_dir):
    return detect.strided(_events(spark, sf_dir), CHANNEL, ["t", "event_id"], 3).select("event_id", "idx")


def sessions(spark, sf_dir):
    return intervals.sessions(_hits(_relative(spark, sf_dir)), CHANNEL, gap=GAP)


def channel_summary(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    hit = F.col("value") >= detect.threshold(F.col("topic"), CONF, OVERRIDES)
    return detect.channel_summary(rel, CHANNEL, "t", hit, 3).select("file", "topic", "messages", "with_hits", "start_t", "end_t", "checked", "hold_us", F.floor(F.col("fps") * 1e6).alias("fps_millionths"))


def interval_union(spark, sf_dir):
    return _drops(spark, sf_dir)


def complement_keep(spark, sf_dir):
    return _keep(spark, sf_dir)


def gaps_removed(spark, sf_dir):
    return intervals.gaps(_keep(spark, sf_dir), _bounds(spark, sf_dir), BY)


def plan_summary(spark, sf_dir):
    return intervals.plan_summary(_keep(spark, sf_dir), _bounds(spark, sf_dir), BY)


def min_keep_sweep(spark, sf_dir):
    return intervals.sweep(_drops(spark, sf_dir), _bounds(spark, sf_dir), BY, SWEEP)


def calibrate_conf(spark, sf_dir):
    return detect.calibrate(_events(spark, sf_dir), ["topic"], "value", LEVELS)


def keyframe_trim(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return detect.from_first_keyframe(rows, CHANNEL, "t", F.col("event_id") % 7 == 3).select("event_id", "no_keyframe")


def snap_forward(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    keys = _keys(rel).withColumn("k", F.col("t"))
    return joins.asof(_hits(rel).select("file", "topic", "t", "event_id"), keys, CHANNEL, "t", "k", "next_key", forward=True).na.fill(-1, ["next_key"])


def snap_back(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    keys = _keys(rel).withColumn("k", F.col("t"))
    return joins.asof(_hits(rel).select("file", "topic", "t", "event_id"), keys, CHANNEL, "t", "k", "prev_key").na.fill(-1, ["prev_key"])


def cut_clips(spark, sf_dir):
    return _clips(spark, sf_dir)


def cut_targets(spark, sf_dir):
    return _targets(spark, sf_dir).select("file", "kind", "name", "a", "b")


def route_messages(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    spans = _keep(spark, sf_dir).withColumn("kind", F.lit("keep")).unionByName(_drops(spark, sf_dir).withColumn("kind", F.lit("drop")))
    return joins.route(rel.select("event_id", "file", "t"), spans, BY, cell=HOUR).select("event_id", "file", "kind", "a", "b")


def _held(spark, sf_dir, f):
    rel = _relative(spark, sf_dir)
    return rel.select("event_id", f(rel, CHANNEL, "t", F.col("value") >= CONF, 5).alias("held"))


def hold_max(spark, sf_dir):
    return _held(spark, sf_dir, detect.hold_any)


def hold_majority(spark, sf_dir):
    return _held(spark, sf_dir, detect.hold_majority)


def _frames(spark: SparkSession, sf_dir: str, last: str) -> DataFrame:
    """All rows as frames, with the number of their recording's last tick."""
    e = _events(spark, sf_dir).join(_recordings(spark, sf_dir), "file")
    return e.select("file", "topic", (F.col("t") - F.col("t0")).alias("t"), "event_id", F.expr(last).cast("long").alias("last"))


def mosaic_align(spark, sf_dir):
    """An output clock of 12 hours, each topic's latest frame at a tick, held until the next."""
    step = 12 * HOUR
    shown = joins.asof_clock(_frames(spark, sf_dir, f"duration div {step}"), CHANNEL, "t", "event_id", "frame_id", 0, step, "last")
    return shown.select("file", "topic", F.col("k").cast("int").alias("k"), (F.col("k") * step).alias("t"), F.coalesce("frame_id", F.lit(-1)).alias("frame_id"))


def asof_tolerance(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    keys = _keys(rel).withColumn("k", F.col("t"))
    return joins.asof(_hits(rel).select("file", "topic", "t", "event_id"), keys, CHANNEL, "t", "k", "near_key", within=24 * HOUR).na.fill(-1, ["near_key"])


def band_join_boxes(spark, sf_dir):
    rel = _relative(spark, sf_dir)
    hits = _hits(rel).select("file", "topic", F.col("event_id").alias("hit_id"), F.col("t").alias("hit_t"))
    return joins.band(rel.select("file", "topic", "event_id", "t"), hits, CHANNEL, "t", "hit_t", 2 * HOUR).select("event_id", "hit_id")


def modal_format(spark, sf_dir):
    return detect.modal(_table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


def manifest_upsert(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return manifest.upsert(orders.where("o_orderkey % 3 <> 0"), orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("new")), "o_orderkey")


def left_join_status(spark, sf_dir):
    sources = _table(spark, sf_dir, "customer").select("c_custkey")
    reports = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("duration"))
    return manifest.bind(sources, reports, "c_custkey", "duration", 8)


def keyed_last_wins(spark, sf_dir):
    return manifest.last_wins(_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", ["o_orderkey"])


def record_histogram(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


def head_per_topic(spark, sf_dir):
    return detect.head(_events(spark, sf_dir), ["topic"], ["t", "event_id"], 100).select("event_id", "topic", "idx")


def payload_swap(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    new = docs.where("doc_id % 11 <> 0").withColumn("text", F.upper("text"))
    got = detect.swap_payload(docs, new, ["source"], ["doc_id"], "text", cell=1 << 14)
    return got.select("source", F.col("idx").cast("int").alias("idx"), "status", F.length("text").alias("n"))


def sha256_digest(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


def _mapped(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """f over the columns' values of each row, Arrow columns in and out."""
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = zip(*map(f, *(c.to_pylist() for c in b.columns))) if b.num_rows else ([] for _ in kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(out, kinds)], schema=kinds)

    return df.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])


def protobuf_roundtrip(spark, sf_dir):
    def one(doc_id, text):
        raw = wire.encode({1: str(doc_id).encode(), 3: b"old"}) + b"\x28\x05"
        got = wire.fields(wire.splice(raw, 3, (text or "").encode()))
        return int(got[1]), hashlib.sha256(got[3]).hexdigest()

    return _mapped(_table(spark, sf_dir, "documents").select("doc_id", "text"), one, "doc_id long, digest string")


def _packets(doc_id: int, text: str | None = None) -> bytes:
    """Access units that hold a text: one for each 0..id % 4, the last a keyframe where id % 5 is 0. (UTF-8 has no start codes.)"""
    n, raw = doc_id % 4 + 1, (text or "").replace("\0", "").encode()
    kinds = [0x65 if doc_id % 5 == 0 and i == n - 1 else 0x41 for i in range(n)]
    return b"".join(wire.DELIMITER + b"\xf0" + b"\x00\x00\x01" + bytes([k]) + raw for k in kinds)


def keyframe_udf(spark, sf_dir):
    return _mapped(_table(spark, sf_dir, "documents").select("doc_id", "text"), lambda i, t: (i, wire.is_keyframe(_packets(i, t))), "doc_id long, is_key boolean")


def au_split(spark, sf_dir):
    def one(i, t):
        parts = wire.access_units(_packets(i, t))
        return i, len(parts), sum(map(len, parts)), hashlib.sha256(b"".join(p[10:] for p in parts)).hexdigest()

    return _mapped(_table(spark, sf_dir, "documents").select("doc_id", "text"), one, "doc_id long, units long, n_bytes long, digest string")


def _log(spark, sf_dir) -> str:
    """All events as logs in a new folder, each file one stretch of a topic's time."""
    mcap_source.register(spark)
    path = scratch(spark, "log")
    e = _events(spark, sf_dir)
    rows = e.select("topic", F.lit("event").alias("schema_name"), F.lit("text").alias("message_encoding"), (F.col("t") * 1000).alias("log_time"), F.col("event_id").alias("sequence"), F.col("file").cast("string").cast("binary").alias("data"))
    rows.repartitionByRange(4, "topic", "log_time").sortWithinPartitions("log_time").write.format("mcap").mode("append").save(path)
    return path


def mcap_roundtrip(spark, sf_dir):
    got = spark.read.format("mcap").load(_log(spark, sf_dir))
    return got.select(F.col("sequence").alias("event_id"), "topic", F.col("data").cast("string").cast("long").alias("file"), F.col("log_time"))


def mcap_topic_scan(spark, sf_dir):
    got = spark.read.format("mcap").option("mode", "sequential").load(_log(spark, sf_dir)).where("topic IN ('click', 'error')")
    return got.groupBy("topic").agg(F.count("*").alias("n"), F.max("log_time").alias("last_t"))


def mcap_channels(spark, sf_dir):
    return spark.read.format("mcap").option("records", "channels").load(_log(spark, sf_dir)).select("topic", "message_encoding", "schema_name").distinct()


def mcap_statistics(spark, sf_dir):
    """Messages of all files, and the topics of their channels, which several files may share."""
    read, path = spark.read.format("mcap"), _log(spark, sf_dir)
    files = read.option("records", "statistics").load(path).select("status", "messages", F.lit(None).cast("string").alias("topic"))
    topics = read.option("records", "channels").load(path).select(F.lit("ok").alias("status"), F.lit(0).cast("long").alias("messages"), "topic")
    return files.unionByName(topics).groupBy("status").agg(F.sum("messages").alias("messages"), F.count_distinct("topic").alias("channels"))


def box_arithmetic(spark, sf_dir):
    b = F.struct(F.floor(F.col("l_quantity")).alias("x"), F.col("l_linenumber").cast("double").alias("y"), F.lit(8.0).alias("w"), F.lit(4.0).alias("h"), F.lit(0.5).alias("score"))
    got = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", boxes.expanded(boxes.rescaled(boxes.from_xywh(b), F.lit(2.0), F.lit(0.5)), 1.5, F.lit(100), F.lit(6)).alias("b"))
    return got.where(boxes.large_enough(F.col("b"), 2.5)).select("l_orderkey", "l_linenumber", "b.x1", "b.y1", "b.x2", "b.y2")


def nms_boxes(spark, sf_dir):
    def one(vec_id, v):
        x = np.array(v[: len(v) // 5 * 5], float).reshape(-1, 5)
        b = np.stack([np.abs(x[:, 0]) * 100, np.abs(x[:, 1]) * 100, np.abs(x[:, 0]) * 100 + 20, np.abs(x[:, 1]) * 100 + 20, np.abs(x[:, 4])], 1)
        kept = boxes.suppress(b, 0.3, 0.05)
        return vec_id, len(kept), float(kept[:, 4].max()) if len(kept) else 0.0

    return _mapped(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), one, "vec_id long, kept long, best double")


def lpt_shard(spark, sf_dir):
    sizes = [(r[0], r[1]) for r in _table(spark, sf_dir, "supplier").select("s_name", F.abs(F.floor("s_acctbal")).cast("long")).collect()]  # a list of files, on the driver
    rows = [(i, name) for i, part in enumerate(manifest.balance(sizes, 4)) for name in part]
    return spark.createDataFrame(rows, "bucket int, name string")


def paint_dilate_fill(spark, sf_dir):
    def one(i):
        frame = np.full((64, 64, 3), i % 256, np.uint8)
        mask = boxes.dilate(boxes.paint((64, 64), np.array([[20, 20, 40, 36]]), ellipse=i % 2 == 0), int(i % 7))
        return i, int(mask.sum()), int((boxes.fill(frame, mask, "grey") != frame).any(axis=2).sum())

    return _mapped(_table(spark, sf_dir, "embeddings").select("vec_id"), one, "vec_id long, masked long, changed long")


def _streamed(spark, sf_dir) -> DataFrame:
    """The events as a stream, closed: its last row is far ahead, in the same batch, and of a recording and topic of its own. The
    watermark that follows from it ends what the events have left open. (Times in pandas end in 2262.)"""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = _table(spark, sf_dir, "events").schema
    # A pattern, as a stream's path may be a folder or a pattern, but not a file.
    e = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    e = e.select("event_id", F.col("user_id").alias("file"), F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("ts"), "value")
    far = {"ts": F.lit("2262-01-01").cast("timestamp"), "value": F.lit(1e9)}
    end = spark.range(1).select(*[far.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in e.schema.fields])
    last = scratch(spark, "stream-end")
    end.write.parquet(last)
    return e.unionByName(spark.readStream.schema(end.schema).parquet(last))


def temporal_stream_sessions(spark, sf_dir):
    e = _streamed(spark, sf_dir)
    hits = e.where(F.col("value") >= detect.threshold(F.coalesce("topic", F.lit("")), CONF, OVERRIDES)).select(*CHANNEL, "ts")
    return streaming.run_once(streaming.stream_sessions(hits, CHANNEL, "ts", "6 hours"), scratch(spark, "stream-sessions"), scratch(spark, "stream-state"))


def hold_max_stream(spark, sf_dir):
    e = _streamed(spark, sf_dir).withColumn("flag", (F.col("value") >= CONF).cast("int"))
    out = streaming.hold_stream(e, CHANNEL, "ts", "event_id", "flag", 5).where("event_id IS NOT NULL").select("event_id", "held")
    return streaming.run_once(out, scratch(spark, "stream-held"), scratch(spark, "stream-state"))


def _boxed(df: DataFrame) -> DataFrame:
    """A row's detections as boxes: as many as its id says, of which each tells its score; none under the threshold."""
    box = lambda i: F.array(F.lit(0.0), F.lit(0.0), F.lit(8.0), i.cast("double"), F.col("value"))
    return df.withColumn("boxes", F.when(F.col("value") >= CONF, F.transform(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 3), box)))


def _held_boxes(df: DataFrame) -> DataFrame:
    """What an array of boxes holds, in order."""
    texts = F.transform("boxes", lambda b: F.concat_ws(":", F.get(b, F.lit(3)).cast("long").cast("string"), F.floor(F.get(b, F.lit(4)) * 1000).cast("string")))
    return df.select("event_id", F.size("boxes").alias("n"), F.array_join(texts, ",").alias("held"))


def hold_boxes(spark, sf_dir):
    rel = _boxed(_relative(spark, sf_dir))
    return _held_boxes(rel.select("event_id", detect.hold_boxes(rel, CHANNEL, ["t", "event_id"], "boxes", 5).alias("boxes")))


def hold_boxes_stream(spark, sf_dir):
    streaming.use_stateful_processors(spark)
    held = streaming.hold_boxes_stream(_boxed(_streamed(spark, sf_dir)), CHANNEL, "ts", "event_id", "boxes", 5).where("event_id IS NOT NULL")
    return _held_boxes(streaming.run_once(held, scratch(spark, "stream-boxes"), scratch(spark, "stream-state")))


def _report(spark, sf_dir) -> DataFrame:
    """Detection reports of all recordings, written as JSON and read again; every eleventh recording failed."""
    e = _events(spark, sf_dir)
    each = e.groupBy(*CHANNEL).agg(F.count("*").alias("messages"), F.min("t").alias("start"), F.max("t").alias("end")).withColumn("codec", F.lit("h264")).withColumn("checked", F.col("messages"))
    rows = detect.indexed(e, CHANNEL, ["t", "event_id"], "frame")
    hits = _hits(rows)
    spans = intervals.sessions(hits, CHANNEL, gap=GAP).join(each, CHANNEL).select(*CHANNEL, (F.col("a") - F.col("start")).alias("a"), (F.col("b") - F.col("start")).alias("b"))
    found = hits.select(*CHANNEL, F.col("frame").cast("int").alias("frame"), "t", F.array(F.array(F.lit(0.0), F.lit(0.0), F.lit(8.0), F.lit(8.0), F.col("value"))).alias("boxes"))
    bad = F.col("file") % 11 == 5
    statuses = e.select("file").distinct().select("file", F.when(bad, "error").otherwise("ok").alias("status"), F.when(bad, "unreadable").alias("error"))
    path = scratch(spark, "report")
    reports.write_report(reports.build_report(each, spans, found, statuses), path)
    return reports.read_report(spark, path, lines=True).withColumn("file", F.col("file").cast("long"))


def report_union(spark, sf_dir):
    return intervals.union(intervals.pad(reports.intervals(_report(spark, sf_dir)), 0, PAD), BY)


def report_summary(spark, sf_dir):
    return reports.report_summary(_report(spark, sf_dir))


def report_detections(spark, sf_dir):
    return reports.detections(_report(spark, sf_dir)).select("file", "topic", "frame", "t", F.get(F.get("boxes", F.lit(0)), F.lit(4)).alias("score"))


def quiet_report(spark, sf_dir):
    quiet = reports.without_detections(_report(spark, sf_dir))
    assert "detections" not in quiet.schema["channels"].dataType.elementType.names
    return quiet.select("file", F.explode("channels").alias("c")).select("file", "c.topic", "c.messages", "c.frames_with_faces")


def nearby_detections(spark, sf_dir):
    return reports.nearby(reports.detections(_report(spark, sf_dir)), HOUR).select("topic", "t", F.size("boxes").alias("boxes"))


def file_rollup(spark, sf_dir):
    rows = _relative(spark, sf_dir).withColumn("codec", F.when(F.col("event_id") % 50 == 0, "h265").otherwise("h264"))
    return reports.file_rollup(rows, BY, "topic", "t", "codec").withColumn("formats", F.array_join("formats", ","))


def blur_summary(spark, sf_dir):
    rows = _hits(_relative(spark, sf_dir)).groupBy("file").agg(F.count("*").alias("frames_with_faces"))
    kinds = ["blurred", "copied", "copied_unscanned", "error"]
    return reports.run_summary(rows.withColumn("status", F.element_at(F.array(*map(F.lit, kinds)), (F.col("file") % 4 + 1).cast("int"))), "status", kinds, "frames_with_faces")


def cut_summary(spark, sf_dir):
    return reports.cut_summary(_stored(_clips(spark, sf_dir), "clips"), _bounds(spark, sf_dir), BY)


def first_spans(spark, sf_dir):
    return reports.first_spans(_drops(spark, sf_dir), BY)


def detection_summary(spark, sf_dir):
    hits = _hits(_relative(spark, sf_dir))
    side = F.floor(F.col("value") / 10).cast("double")
    boxes_ = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")), lambda i: F.struct(F.lit(1.5).alias("x1"), F.lit(0.0).alias("y1"), (side + 2 + i).alias("x2"), (side + 9).alias("y2"), F.lit(1.0).alias("score")))
    return detect.detection_summary(hits.withColumn("boxes", boxes_), intervals.sessions(hits, CHANNEL, gap=GAP), CHANNEL)


def frame_geometry(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select("p_partkey", (640 + F.col("p_size") * 7).alias("w"), (360 + F.col("p_partkey") % 900).alias("h"), (F.col("p_partkey") % 800 - 400).alias("rot"))
    p = p.withColumn("turned", scalars.rotation(F.col("rot"))).withColumn("d", scalars.displayed_size(F.col("w"), F.col("h"), F.col("turned"))).withColumn("m", scalars.detector_size(F.col("d.w"), F.col("d.h")))
    g = scalars.grid((F.col("p_partkey") % 9 + 1).cast("int"), 640, F.col("d.w"), F.col("d.h"))
    return p.withColumn("g", g).select("p_partkey", "turned", F.col("d.w").alias("shown_w"), F.col("m.w").alias("model_w"), F.col("m.h").alias("model_h"), scalars.even(F.col("w") * 0.5).alias("half_w"), "g.cols", "g.rows", "g.tile_height")


def names_and_tints(spark, sf_dir):
    topic = F.concat(F.lit("/cam/"), F.col("p_name"), F.lit("/video/"))
    return _table(spark, sf_dir, "part").select("p_partkey", scalars.display_name(topic).alias("name"), scalars.tint(F.col("p_name")).alias("c")).select("p_partkey", "name", "c.*")


def excerpt(spark, sf_dir):
    return detect.excerpt(_relative(spark, sf_dir), BY, "topic", ["t", "event_id"], F.col("topic").isin("click", "view"), 10).select("event_id", "idx")


def lock_step(spark, sf_dir):
    got = detect.lock_step(_relative(spark, sf_dir), BY, "topic", ["t", "event_id"], "event_id")
    return got.select("file", "idx", F.size("frames").alias("n"), F.array_join(F.transform("frames", lambda x: x["value"].cast("string")), ",").alias("ids"))


def mosaic_clock(spark, sf_dir):
    """A clock of 12 hours; at a tick each topic shows its latest frame up to half a tick later; every second tick stays."""
    step = 12 * HOUR
    rows = _frames(spark, sf_dir, f"cast(greatest(0, bround(duration / {step})) as long) div 2")
    shown = joins.asof_clock(rows, CHANNEL, "t", "event_id", "frame_id", step // 2, 2 * step, "last")
    return shown.select("file", "topic", (F.col("k") * 2).cast("int").alias("k"), F.coalesce("frame_id", F.lit(-1)).alias("frame_id"))


def top_boxes(spark, sf_dir):
    v = F.transform("embedding", lambda x: x.cast("double"))
    each = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 5).cast("int") - 1), lambda j: F.struct(F.get(v, j * 5 + 4).alias("score"), j.alias("place")))
    best = boxes.top_k(each, 3)
    return _table(spark, sf_dir, "embeddings").select("vec_id", F.size(best).alias("n"), F.get(best, F.lit(0))["score"].alias("first"), F.get(best, F.lit(2))["score"].alias("third"))


def detect_bright(spark, sf_dir):
    """Each embedding of 64 numbers as a picture of 8 x 8, through the detector interface."""
    level = lambda x: F.lpad(F.hex(F.least(F.lit(255), F.floor(F.abs(x.cast("double")) * 1500)).cast("long")), 2, "0")
    pixels = F.unhex(F.array_join(F.transform("embedding", lambda x: F.repeat(level(x), F.lit(3))), ""))
    frames = _table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64).select("vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), pixels.alias("pixels"))
    found = detect.detect_frames(frames, ["vec_id"], detect.BrightBoxDetector).select("vec_id", F.explode("boxes").alias("b"))
    return found.select("vec_id", *[F.col(f"b.{c}").cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")])


def mcap_indexed_scan(spark, sf_dir):
    """Topic and time reach the chunk index."""
    got = spark.read.format("mcap").load(_log(spark, sf_dir)).where("topic = 'click' AND log_time >= 1704500000000000000 AND log_time <= 1706000000000000000")
    return got.select(F.col("sequence").alias("event_id"), "log_time")


def keyframe_scan(spark, sf_dir):
    """Packets of all documents in logs, of which only those with a keyframe come back."""
    mcap_source.register(spark)
    kind = pa.schema([("topic", pa.string()), ("schema_name", pa.string()), ("log_time", pa.int64()), ("sequence", pa.int64()), ("data", pa.binary())])

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few rows at a time: a batch of Spark's holds thousands of texts, and each stands in up to four packets.
        for b in (x.slice(i, 64) for x in batches for i in range(0, x.num_rows, 64)):
            rows = [(s or "", mcap_source.VIDEO if i % 4 else "other", i, i, _packets(i, t) if i % 3 else b"") for i, s, t in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)] if rows else [pa.array([], f.type) for f in kind], schema=kind)

    path = scratch(spark, "packets")
    made = _table(spark, sf_dir, "documents").select("doc_id", "source", "text").mapInArrow(packets, "topic string, schema_name string, log_time long, sequence long, data binary")
    made.write.format("mcap").mode("append").save(path)
    return mcap_source.keyframes(spark, path).select(F.col("sequence").alias("doc_id"))


def cut_write(spark, sf_dir):
    """Each clip and each removed span as a log of its own, read again."""
    mcap_source.register(spark)
    path = scratch(spark, "logs")
    with _merged(spark):
        rel = _relative(spark, sf_dir)
        targets = _stored(_targets(spark, sf_dir).select("file", "name", "a", "b"), "targets")
        met = joins.route(rel.select("event_id", "file", "topic", "t"), targets, BY, cell=HOUR)
        rows = met.select("name", "topic", F.col("t").alias("log_time"), F.col("event_id").alias("sequence"), F.col("event_id").cast("string").cast("binary").alias("data"))
        rows.repartition("name").sortWithinPartitions("name", "log_time", "sequence").write.format("mcap").option("split", "name").option("folders", "true").mode("append").save(path)
    return spark.read.format("mcap").option("folders", "true").load(path).select(F.regexp_replace("file", r"\.mcap$", "").alias("name"), F.col("sequence").alias("event_id"), "topic")


def swap_write(spark, sf_dir):
    """A log of protobuf messages with field 3 of them replaced by place, written and read again: all other bytes are as they were."""
    mcap_source.register(spark)
    e, path, swapped = _events(spark, sf_dir), scratch(spark, "log"), scratch(spark, "swapped")
    part = lambda tag, x: F.concat(F.unhex(F.lit(tag)), F.unhex(F.lpad(F.hex(F.octet_length(x)), 2, "0")), x.cast("binary"))
    data = F.concat(part("0A", F.col("event_id").cast("string")), part("1A", F.col("file").cast("string")), F.unhex(F.lit("2805")))
    rows = e.select("topic", (F.col("t") * 1000).alias("log_time"), F.col("event_id").alias("sequence"), F.lit("protobuf").alias("message_encoding"), data.alias("data"))
    rows.repartitionByRange(4, "topic", "log_time").sortWithinPartitions("log_time").write.format("mcap").mode("append").save(path)
    log = spark.read.format("mcap").load(path)
    new = log.where("sequence % 11 <> 0").withColumn("data", F.concat(F.lit("new "), F.col("sequence").cast("string")).cast("binary"))
    got = detect.swap_payload(log, new, ["topic"], ["log_time", "sequence"], "data", cell=HOUR * 1000, field=3).where("status <> 'extra'")
    got.drop("idx", "status", "file", "ordinal").repartitionByRange(4, "topic", "log_time").sortWithinPartitions("log_time").write.format("mcap").mode("append").save(swapped)
    return spark.read.format("mcap").load(swapped).select(F.col("sequence").alias("event_id"), "topic", F.hex("data").alias("payload"))


def mcap_repair(spark, sf_dir):
    """All logs cut off before the end of their data, repaired and read through their new index."""
    import struct

    whole, cut_off, mended = _log(spark, sf_dir), scratch(spark, "cut-off"), scratch(spark, "repaired")
    names = spark.createDataFrame([(f,) for f in mcap_source._files(whole)], "path string")

    def damage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(cut_off)
        fs.create_dir(root, recursive=True)
        for b in batches:
            for path in b.column(0).to_pylist():
                with mcap_source._open(path) as f:
                    raw = f.read()
                # The footer: 20 bytes before the last magic, first the place of the summary; before that the 13 bytes that end the data.
                end = struct.unpack_from("<Q", raw, len(raw) - 28)[0] - 13
                with fs.open_output_stream(f"{root}/{path.rsplit('/', 1)[-1]}") as out:
                    out.write(raw[:end])
            yield b

    names.mapInArrow(damage, "path string").write.format("noop").mode("overwrite").save()
    done = mcap_source.repair_folder(spark, cut_off, mended)
    got = spark.read.format("mcap").load(mended).join(done.where("status = 'ok' AND ended_early"), "file", "left_semi")
    return got.select(F.col("sequence").alias("event_id"), "topic", F.col("data").cast("string").cast("long").alias("file"), "log_time")


_ASOF = "SELECT h.file, h.topic, h.t, h.event_id, {out} FROM hits h ASOF LEFT JOIN ks k ON k.file = h.file AND k.topic = h.topic AND k.t {op} h.t"
_SUM = """s AS (SELECT {by}, count(*) AS segments, CAST(sum(b - a) AS BIGINT) AS kept, max(b - a) AS longest, list_sort(list(b - a))[count(*) // 2 + 1] AS median FROM {runs} GROUP BY {by})"""
_SUM_OUT = "coalesce(segments, 0) AS segments, coalesce(kept, 0) AS kept, coalesce(longest, 0) AS longest, coalesce(median, 0) AS median, duration - coalesce(kept, 0) AS removed, CASE WHEN duration > 0 THEN CAST(floor(coalesce(kept, 0) * 1000000 / duration) AS BIGINT) ELSE 0 END AS kept_ppm"
_HELD = "SELECT event_id, {f} AS held FROM (SELECT *, CAST(value >= 100 AS INTEGER) AS x FROM rel) WINDOW w AS (PARTITION BY file, topic ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"

_BOXES_HELD = f"""WITH {_REL}, b AS (SELECT *, CASE WHEN value >= 100 THEN list_transform(range(0, event_id % 3 + 1), lambda i: i || ':' || CAST(floor(value * 1000) AS BIGINT)) ELSE [] END AS x FROM rel),
  h AS (SELECT event_id, flatten(list(x) OVER (PARTITION BY file, topic ORDER BY t, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS x FROM b) SELECT event_id, CAST(len(x) AS INTEGER) AS n, array_to_string(x, ',') AS held FROM h"""
_NAMED = f"""{_CLIPS}, g AS (SELECT file, coalesce(lag(b) OVER (PARTITION BY file ORDER BY a), 0) AS a, a AS b FROM clips UNION ALL SELECT bounds.file, coalesce(m, 0), duration FROM bounds LEFT JOIN (SELECT file, max(b) AS m FROM clips GROUP BY file) x ON x.file = bounds.file),
      ge AS (SELECT g.file, a, b, topic FROM g JOIN topics USING (file) WHERE b > a AND b - a >= {HOUR}), gk AS (SELECT ge.file, min(coalesce(k.t, 0)) AS a, ge.b FROM ge ASOF LEFT JOIN ks k ON k.file = ge.file AND k.topic = ge.topic AND k.t <= ge.a GROUP BY ge.file, ge.a, ge.b),
      every AS (SELECT file, a, b, 'clip' AS kind FROM clips UNION ALL SELECT file, a, b, 'removed' FROM gk),
      named AS (SELECT file, kind, printf('%s_%s%02d', CAST(file AS VARCHAR), kind, row_number() OVER (PARTITION BY file, kind ORDER BY a, b) - 1) AS name, a, b FROM every)"""
_OKS = "SELECT DISTINCT file FROM e WHERE file % 11 <> 5"
_THR = "CASE WHEN topic LIKE '%err%' THEN 150 WHEN topic LIKE '%click%' THEN 120 ELSE 100 END"

_PAIRS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "threshold_by_topic": (threshold_by_topic, f"WITH {_HITS} SELECT event_id, file, topic, t FROM hits"),
    "stride_sample": (stride_sample, f"WITH {_E} SELECT event_id, idx FROM (SELECT event_id, CAST(row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS INTEGER) AS idx FROM e) WHERE idx % 3 = 0"),
    "sessions": (sessions, f"WITH {_SESS} SELECT * FROM sess"),
    "channel_summary": (channel_summary, f"WITH {_HITS}, c AS (SELECT file, topic, count(*) AS messages, count(*) FILTER (value >= CASE WHEN topic LIKE '%err%' THEN 150 WHEN topic LIKE '%click%' THEN 120 ELSE 100 END) AS with_hits, min(t) AS start_t, max(t) AS end_t, max(t) - min(t) AS span FROM rel GROUP BY file, topic) SELECT file, topic, messages, with_hits, start_t, end_t, CAST(ceil(messages / 3) AS BIGINT) AS checked, CASE WHEN span > 0 AND messages > 1 THEN CAST(floor(3 * span / (messages - 1)) AS BIGINT) ELSE 0 END AS hold_us, CASE WHEN span > 0 THEN CAST(floor((messages - 1) * 1e6::DOUBLE / span * 1e6::DOUBLE) AS BIGINT) ELSE 0 END AS fps_millionths FROM c"),
    "interval_union": (interval_union, f"WITH {_DROPS} SELECT * FROM drops"),
    "complement_keep": (complement_keep, f"WITH {_KEEP} SELECT * FROM keep"),
    "gaps_removed": (gaps_removed, f"WITH {_KEEP}, g AS (SELECT file, coalesce(lag(b) OVER (PARTITION BY file ORDER BY a), 0) AS a, a AS b FROM keep UNION ALL SELECT bounds.file, coalesce(m, 0), duration FROM bounds LEFT JOIN (SELECT file, max(b) AS m FROM keep GROUP BY file) x ON x.file = bounds.file) SELECT * FROM g WHERE b > a"),
    "plan_summary": (plan_summary, f"WITH {_KEEP}, {_SUM.format(by='file', runs='keep')} SELECT file, duration, {_SUM_OUT} FROM bounds LEFT JOIN s USING (file)"),
    "min_keep_sweep": (min_keep_sweep, f"WITH {_RUNS}, m AS (SELECT unnest({SWEEP}) AS min_keep), r AS (SELECT * FROM runs, m WHERE b - a >= 0 AND b - a >= min_keep), {_SUM.format(by='file, min_keep', runs='r')} SELECT file, min_keep, duration, {_SUM_OUT} FROM (SELECT * FROM bounds, m) LEFT JOIN s USING (file, min_keep)"),
    "calibrate_conf": (calibrate_conf, f"SELECT event_type AS topic, CAST(level AS DOUBLE) AS level, count(*) FILTER (value >= level) AS survivors FROM events, (SELECT unnest({LEVELS}) AS level) GROUP BY 1, 2"),
    "keyframe_trim": (keyframe_trim, f"WITH {_E} SELECT event_id, f IS NULL AS no_keyframe FROM (SELECT *, min(CASE WHEN event_id % 7 = 3 THEN t END) OVER (PARTITION BY file, topic) AS f FROM e) WHERE f IS NULL OR t >= f"),
    "snap_forward": (snap_forward, f"WITH {_HITS}, {_KEYS} {_ASOF.format(out='coalesce(k.t, -1) AS next_key', op='>=')}"),
    "snap_back": (snap_back, f"WITH {_HITS}, {_KEYS} {_ASOF.format(out='coalesce(k.t, -1) AS prev_key', op='<=')}"),
    "cut_clips": (cut_clips, f"WITH {_CLIPS} SELECT * FROM clips"),
    "cut_targets": (cut_targets, f"WITH {_NAMED} SELECT * FROM named"),
    "route_messages": (route_messages, f"WITH {_KEEP}, spans AS (SELECT *, 'keep' AS kind FROM keep UNION ALL SELECT *, 'drop' FROM drops) SELECT event_id, r.file, kind, a, b FROM rel r JOIN spans s ON s.file = r.file AND r.t BETWEEN a AND b"),
    "hold_max": (hold_max, f"WITH {_REL} {_HELD.format(f='max(x) OVER w')}"),
    "hold_max_stream": (hold_max_stream, f"WITH {_REL} {_HELD.format(f='max(x) OVER w')}"),
    "hold_boxes": (hold_boxes, _BOXES_HELD),
    "hold_boxes_stream": (hold_boxes_stream, _BOXES_HELD),
    "hold_majority": (hold_majority, f"WITH {_REL} {_HELD.format(f='CAST(sum(x) OVER w > count(*) OVER w // 2 AS INTEGER)')}"),
    "mosaic_align": (mosaic_align, f"WITH {_REL}, fr AS (SELECT file, topic, t, min(event_id) AS id FROM rel GROUP BY 1, 2, 3), ticks AS (SELECT file, unnest(range(0, duration + 1, {12 * HOUR})) AS t FROM bounds), clock AS (SELECT ticks.file, topic, t FROM ticks JOIN (SELECT DISTINCT file, topic FROM rel) x ON x.file = ticks.file) SELECT c.file, c.topic, CAST(c.t // {12 * HOUR} AS INTEGER) AS k, c.t, coalesce(id, -1) AS frame_id FROM clock c ASOF LEFT JOIN fr ON fr.file = c.file AND fr.topic = c.topic AND fr.t <= c.t"),
    "asof_tolerance": (asof_tolerance, f"WITH {_HITS}, {_KEYS} SELECT file, topic, t, event_id, CASE WHEN t - k <= {24 * HOUR} THEN k ELSE -1 END AS near_key FROM ({_ASOF.format(out='k.t AS k', op='<=')})"),
    "band_join_boxes": (band_join_boxes, f"WITH {_HITS} SELECT r.event_id, h.event_id AS hit_id FROM rel r JOIN hits h ON h.file = r.file AND h.topic = r.topic AND h.t BETWEEN r.t - {2 * HOUR} AND r.t + {2 * HOUR}"),
    "modal_format": (modal_format, "WITH n AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) SELECT o_custkey, arg_max(o_orderpriority, n * 1000000000000 - f) AS o_orderpriority, count(*) AS kinds FROM n GROUP BY 1"),
    "manifest_upsert": (manifest_upsert, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0 UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM orders WHERE o_orderkey % 2 = 0"),
    "left_join_status": (left_join_status, "SELECT c_custkey, n AS duration, CASE WHEN n IS NULL THEN 'no_report' WHEN n < 8 THEN 'too_short' ELSE 'ok' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey"),
    "keyed_last_wins": (keyed_last_wins, "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1"),
    "record_histogram": (record_histogram, f"WITH {_E} SELECT topic, count(*) AS n, min(t) AS first_t, max(t) AS last_t FROM e GROUP BY topic"),
    "head_per_topic": (head_per_topic, f"WITH {_E} SELECT event_id, topic, idx FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY t, event_id) - 1 AS INTEGER) AS idx FROM e) WHERE idx < 100"),
    "payload_swap": (payload_swap, "WITH d AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx FROM documents), n AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx FROM documents WHERE doc_id % 11 <> 0) SELECT d.source, CAST(d.idx AS INTEGER) AS idx, CASE WHEN n.idx IS NULL THEN 'missing' ELSE 'swapped' END AS status, CAST(length(CASE WHEN n.idx IS NULL THEN d.text ELSE replace(upper(replace(n.text, 'ß', 'SS')), 'ẞ', 'SS') END) AS INTEGER) AS n FROM d LEFT JOIN n USING (source, idx)"),
    "sha256_digest": (sha256_digest, "SELECT doc_id, sha256(text) AS digest FROM documents"),
    "protobuf_roundtrip": (protobuf_roundtrip, "SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents"),
    "keyframe_udf": (keyframe_udf, "SELECT doc_id, doc_id % 5 = 0 AS is_key FROM documents"),
    "au_split": (au_split, "SELECT doc_id, doc_id % 4 + 1 AS units, CAST((10 + octet_length(encode(replace(coalesce(text, ''), chr(0), '')))) * (doc_id % 4 + 1) AS BIGINT) AS n_bytes, sha256(repeat(replace(coalesce(text, ''), chr(0), ''), doc_id % 4 + 1)) AS digest FROM documents"),
    "mcap_roundtrip": (mcap_roundtrip, f"WITH {_E} SELECT event_id, topic, file, t * 1000 AS log_time FROM e"),
    "mcap_topic_scan": (mcap_topic_scan, f"WITH {_E} SELECT topic, count(*) AS n, max(t) * 1000 AS last_t FROM e WHERE topic IN ('click', 'error') GROUP BY topic"),
    "mcap_channels": (mcap_channels, "SELECT DISTINCT event_type AS topic, 'text' AS message_encoding, 'event' AS schema_name FROM events"),
    "mcap_statistics": (mcap_statistics, "SELECT 'ok' AS status, count(*) AS messages, count(DISTINCT event_type) AS channels FROM events"),
    "box_arithmetic": (box_arithmetic, "WITH b AS (SELECT l_orderkey, l_linenumber, floor(l_quantity) * 2 AS x1, l_linenumber * 0.5::DOUBLE AS y1, floor(l_quantity) * 2 + 16 AS x2, (l_linenumber + 4) * 0.5::DOUBLE AS y2 FROM lineitem), g AS (SELECT l_orderkey, l_linenumber, greatest(0::DOUBLE, x1 - 4) AS x1, greatest(0::DOUBLE, y1 - 0.5::DOUBLE) AS y1, least(100::DOUBLE, x2 + 4) AS x2, least(6::DOUBLE, y2 + 0.5::DOUBLE) AS y2 FROM b) SELECT * FROM g WHERE least(x2 - x1, y2 - y1) >= 2.5"),
    "report_union": (report_union, f"WITH {_DROPS} SELECT * FROM drops WHERE file % 11 <> 5"),
    "report_summary": (report_summary, f"WITH {_SESS}, k AS (SELECT file, count(*) AS k FROM hits GROUP BY file), u1 AS (SELECT *, max(b) OVER (PARTITION BY file ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sess), u2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM u1), f AS (SELECT file, sum(b - a) AS c FROM (SELECT file, min(a) AS a, max(b) AS b FROM u2 GROUP BY file, g) GROUP BY file), r AS (SELECT bounds.file % 11 <> 5 AS ok, coalesce(k, 0) AS k, coalesce(c, 0) AS c, duration FROM bounds LEFT JOIN k ON k.file = bounds.file LEFT JOIN f ON f.file = bounds.file) SELECT count(*) AS files, count(*) FILTER (ok) AS ok, 0::BIGINT AS skipped_no_video, count(*) FILTER (NOT ok) AS error, count(*) FILTER (ok AND k > 0) AS files_with_faces, CAST(coalesce(sum(k) FILTER (ok), 0) AS BIGINT) AS frames_with_faces, CAST(coalesce(sum(c) FILTER (ok), 0) AS BIGINT) AS face_time, CAST(coalesce(sum(duration) FILTER (ok), 0) AS BIGINT) AS video_time FROM r"),
    "report_detections": (report_detections, f"WITH {_E} SELECT file, topic, frame, t, value AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS INTEGER) AS frame FROM e) WHERE value >= {_THR} AND file % 11 <> 5"),
    "quiet_report": (quiet_report, f"WITH {_E} SELECT file, topic, count(*) AS messages, count(*) FILTER (value >= {_THR}) AS frames_with_faces FROM e WHERE file % 11 <> 5 GROUP BY file, topic"),
    "nearby_detections": (nearby_detections, f"WITH {_E} SELECT topic, (t + {HOUR // 2}) // {HOUR} * {HOUR} AS t, CAST(count(*) AS INTEGER) AS boxes FROM e WHERE value >= {_THR} AND file % 11 <> 5 GROUP BY 1, 2"),
    "file_rollup": (file_rollup, f"WITH {_REL}, c AS (SELECT file, topic, count(*) AS n, min(t) AS lo, max(t) AS hi, max(t) - min(t) AS span FROM rel GROUP BY file, topic), k AS (SELECT file, string_agg(DISTINCT CASE WHEN event_id % 50 = 0 THEN 'h265' ELSE 'h264' END, ',' ORDER BY CASE WHEN event_id % 50 = 0 THEN 'h265' ELSE 'h264' END) AS formats FROM rel GROUP BY file) SELECT c.file, count(*) AS channels, CAST(sum(n) AS BIGINT) AS messages, min(lo) AS start_t, max(hi) - min(lo) AS duration, min(n) AS shortest, max(CASE WHEN n > 1 AND span > 0 THEN CAST(floor((n - 1) * 1e6::DOUBLE / span * 1e6::DOUBLE) AS BIGINT) END) AS fps_millionths, any_value(formats) AS formats FROM c JOIN k ON k.file = c.file GROUP BY c.file"),
    "blur_summary": (blur_summary, f"WITH {_HITS}, k AS (SELECT file, count(*) AS k FROM hits GROUP BY file) SELECT count(*) AS files, count(*) FILTER (file % 4 = 0) AS blurred, count(*) FILTER (file % 4 = 1) AS copied, count(*) FILTER (file % 4 = 2) AS copied_unscanned, count(*) FILTER (file % 4 = 3) AS error, CAST(coalesce(sum(k), 0) AS BIGINT) AS frames_with_faces FROM k"),
    "cut_summary": (cut_summary, f"WITH {_CLIPS} SELECT (SELECT count(*) FROM bounds) AS files, count(*) AS clips, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS kept, (SELECT CAST(sum(duration) AS BIGINT) FROM bounds) AS source FROM clips"),
    "first_spans": (first_spans, f"WITH {_DROPS}, n AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY a, b) AS r FROM drops) SELECT file, string_agg(a || '-' || b, ', ' ORDER BY a, b) FILTER (r <= 4) AS shown, CAST(greatest(0, count(*) - 4) AS INTEGER) AS more FROM n GROUP BY file"),
    "detection_summary": (detection_summary, f"WITH {_SESS}, s AS (SELECT file, topic, CAST(sum(b - a) AS BIGINT) AS face_time FROM sess GROUP BY 1, 2) SELECT h.file, h.topic, count(*) AS frames_with_faces, CAST(max(event_id % 3 + 1) AS INTEGER) AS max_faces_in_frame, max(least(CAST(floor(value / 10) AS INTEGER) + 1 + CAST(event_id % 3 AS INTEGER), CAST(floor(value / 10) AS INTEGER) + 9)) AS largest_face_px, any_value(face_time) AS face_time FROM hits h JOIN s ON s.file = h.file AND s.topic = h.topic GROUP BY h.file, h.topic"),
    "frame_geometry": (frame_geometry, """WITH p AS (SELECT p_partkey, 640 + p_size * 7 AS w, 360 + p_partkey % 900 AS h, (CAST(round_even((p_partkey % 800 - 400) / 90.0::DOUBLE, 0) AS INTEGER) * 90 % 360 + 360) % 360 AS turned FROM part),
      d AS (SELECT *, CASE WHEN turned IN (90, 270) THEN h ELSE w END AS dw, CASE WHEN turned IN (90, 270) THEN w ELSE h END AS dh FROM p), m AS (SELECT *, dw * (1200::DOUBLE / least(dw, dh)) AS mw, dh * (1200::DOUBLE / least(dw, dh)) AS mh FROM d),
      x AS (SELECT *, CASE WHEN greatest(mw, mh) > 1200 THEN 1200::DOUBLE / greatest(mw, mh) ELSE 1 END AS down, CASE WHEN p_partkey % 9 + 1 > 4 THEN 3 ELSE 2 END AS cols FROM m)
      SELECT p_partkey, CAST(turned AS INTEGER) AS turned, CAST(dw AS BIGINT) AS shown_w, CAST(floor(mw * down + 0.5) AS INTEGER) AS model_w, CAST(floor(mh * down + 0.5) AS INTEGER) AS model_h, CAST(floor(round_even(w * 0.5::DOUBLE, 0) / 2) * 2 AS INTEGER) AS half_w, cols, CAST(ceil((p_partkey % 9 + 1) / cols) AS INTEGER) AS rows, CAST(floor(round_even(640::DOUBLE * dh / dw, 0) / 2) * 2 AS INTEGER) AS tile_height FROM x"""),
    "names_and_tints": (names_and_tints, """WITH p AS (SELECT p_partkey, replace(trim('/cam/' || p_name || '/video/', '/'), '/video', '') AS name, CAST(('0x' || substr(sha256(p_name), 1, 4))::INTEGER % 180 AS INTEGER) AS hue FROM part),
      x AS (SELECT *, hue // 30 AS s, 230 * (1 - 200 / 255::DOUBLE) AS low, 230 * (1 - 200 / 255::DOUBLE * ((hue % 30) / 30::DOUBLE)) AS q, 230 * (1 - 200 / 255::DOUBLE * (1 - (hue % 30) / 30::DOUBLE)) AS u FROM p)
      SELECT p_partkey, name, hue, CAST(round_even([low, low, u, 230, 230, q][s + 1], 0) AS INTEGER) AS b, CAST(round_even([u, 230, 230, q, low, low][s + 1], 0) AS INTEGER) AS g, CAST(round_even([230, q, low, low, u, 230][s + 1], 0) AS INTEGER) AS r FROM x"""),
    "excerpt": (excerpt, f"WITH {_REL}, i AS (SELECT *, CAST(row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS INTEGER) AS idx, topic IN ('click', 'view') AS v FROM rel), c AS (SELECT file, topic, count(*) AS k, max(t) AS m FROM i WHERE v AND idx < 10 GROUP BY 1, 2), n AS (SELECT file, min(k) AS common, max(m) AS cutoff FROM c GROUP BY file) SELECT event_id, idx FROM i JOIN n ON n.file = i.file WHERE CASE WHEN v THEN idx < common ELSE t <= cutoff END"),
    "lock_step": (lock_step, f"WITH {_REL}, i AS (SELECT *, CAST(row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS INTEGER) AS idx FROM rel) SELECT file, idx, CAST(count(*) AS INTEGER) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY topic) AS ids FROM i GROUP BY file, idx"),
    "mosaic_clock": (mosaic_clock, f"WITH {_REL}, fr AS (SELECT file, topic, t, min(event_id) AS id FROM rel GROUP BY 1, 2, 3), ticks AS (SELECT file, unnest(range(0, CAST(round_even(duration / {12 * HOUR}::DOUBLE, 0) AS BIGINT) + 1)) AS k FROM bounds), clock AS (SELECT ticks.file, topic, k, k * {12 * HOUR} + {6 * HOUR} AS t FROM ticks JOIN (SELECT DISTINCT file, topic FROM rel) x ON x.file = ticks.file WHERE k % 2 = 0) SELECT c.file, c.topic, CAST(c.k AS INTEGER) AS k, coalesce(id, -1) AS frame_id FROM clock c ASOF LEFT JOIN fr ON fr.file = c.file AND fr.topic = c.topic AND fr.t <= c.t"),
    "top_boxes": (top_boxes, "WITH s AS (SELECT vec_id, list_sort(list_transform(range(0, len(embedding) // 5), lambda j: CAST(embedding[5 * j + 5] AS DOUBLE)), 'DESC') AS s FROM embeddings) SELECT vec_id, CAST(least(3, len(s)) AS INTEGER) AS n, s[1] AS first, s[3] AS third FROM s"),
    "detect_bright": (detect_bright, "WITH p AS (SELECT vec_id, unnest(range(0, 64)) AS i, unnest(embedding) AS x FROM embeddings WHERE len(embedding) = 64), b AS (SELECT * FROM p WHERE least(255, floor(abs(CAST(x AS DOUBLE)) * 1500)) >= 250) SELECT vec_id, CAST(min(i % 8) AS INTEGER) AS x1, CAST(min(i // 8) AS INTEGER) AS y1, CAST(max(i % 8) + 1 AS INTEGER) AS x2, CAST(max(i // 8) + 1 AS INTEGER) AS y2 FROM b GROUP BY vec_id"),
    "mcap_indexed_scan": (mcap_indexed_scan, f"WITH {_E} SELECT event_id, t * 1000 AS log_time FROM e WHERE topic = 'click' AND t BETWEEN 1704500000000000 AND 1706000000000000"),
    "keyframe_scan": (keyframe_scan, "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 AND doc_id % 3 <> 0 AND doc_id % 4 <> 0"),
    "cut_write": (cut_write, f"WITH {_NAMED} SELECT name, event_id, topic FROM rel r JOIN named n ON n.file = r.file AND r.t BETWEEN a AND b"),
    "swap_write": (swap_write, f"WITH {_E}, d AS (SELECT event_id, topic, file, row_number() OVER (PARTITION BY topic ORDER BY t, event_id) AS idx FROM e), n AS (SELECT topic, event_id AS new, row_number() OVER (PARTITION BY topic ORDER BY t, event_id) AS idx FROM e WHERE event_id % 11 <> 0), v AS (SELECT event_id, d.topic, event_id::VARCHAR AS one, CASE WHEN n.idx IS NULL THEN d.file::VARCHAR ELSE 'new ' || n.new END AS three FROM d LEFT JOIN n ON n.topic = d.topic AND n.idx = d.idx) SELECT event_id, topic, '0A' || printf('%02X', strlen(one)) || hex(one) || '1A' || printf('%02X', strlen(three)) || hex(three) || '2805' AS payload FROM v"),
    "mcap_repair": (mcap_repair, f"WITH {_E} SELECT event_id, topic, file, t * 1000 AS log_time FROM e"),
    "nms_boxes": (nms_boxes, """WITH RECURSIVE v AS (SELECT vec_id, embedding AS e, unnest(range(0, len(embedding) // 5)) AS j FROM embeddings),
      b AS (SELECT vec_id, j, abs(CAST(e[5 * j + 1] AS DOUBLE)) * 100 AS x1, abs(CAST(e[5 * j + 2] AS DOUBLE)) * 100 AS y1, abs(CAST(e[5 * j + 5] AS DOUBLE)) AS s FROM v),
      o AS MATERIALIZED (SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, j) AS i, {'x1': x1, 'y1': y1, 'x2': x1 + 20, 'y2': y1 + 20, 's': s} AS b FROM b),
      r AS (SELECT vec_id, CAST(0 AS BIGINT) AS i, list_filter([b], lambda z: false) AS kept FROM o WHERE i = 1
        UNION ALL SELECT o.vec_id, o.i, CASE WHEN len(list_filter(list_transform(r.kept, lambda k: {'c': greatest(0::DOUBLE, least(k.x2, o.b.x2) - greatest(k.x1, o.b.x1)) * greatest(0::DOUBLE, least(k.y2, o.b.y2) - greatest(k.y1, o.b.y1)),
            'a': (k.x2 - k.x1) * (k.y2 - k.y1) + (o.b.x2 - o.b.x1) * (o.b.y2 - o.b.y1)}), lambda z: z.a > z.c AND z.c / (z.a - z.c) > 0.3::DOUBLE)) = 0 THEN list_append(r.kept, o.b) ELSE r.kept END
        FROM r JOIN o ON o.vec_id = r.vec_id AND o.i = r.i + 1),
      l AS (SELECT vec_id, list_transform(list_filter(arg_max(kept, i), lambda z: z.s > 0.05::DOUBLE), lambda z: z.s) AS s FROM r GROUP BY vec_id)
      SELECT e.vec_id, coalesce(len(s), 0) AS kept, coalesce(list_max(s), 0::DOUBLE) AS best FROM embeddings e LEFT JOIN l ON l.vec_id = e.vec_id"""),
    "lpt_shard": (lpt_shard, """WITH RECURSIVE s AS MATERIALIZED (SELECT s_name AS name, CAST(abs(floor(s_acctbal)) AS BIGINT) AS size, row_number() OVER (ORDER BY abs(floor(s_acctbal)) DESC, s_name) AS i FROM supplier),
      r AS (SELECT CAST(0 AS BIGINT) AS i, CAST([0, 0, 0, 0] AS BIGINT[]) AS load, CAST(NULL AS VARCHAR) AS name, CAST(0 AS INTEGER) AS bucket
        UNION ALL SELECT s.i, list_transform(load, lambda x, k: x + CASE WHEN k = list_position(load, list_min(load)) THEN size ELSE 0 END), s.name, CAST(list_position(load, list_min(load)) - 1 AS INTEGER) FROM r JOIN s ON s.i = r.i + 1)
      SELECT bucket, name FROM r WHERE i > 0"""),
    "paint_dilate_fill": (paint_dilate_fill, """WITH p AS (SELECT x, y FROM (SELECT unnest(range(0, 64)) AS x), (SELECT unnest(range(0, 64)) AS y)),
      m AS (SELECT 0 AS shape, x, y FROM p WHERE ((x - 30) / 10::DOUBLE) ^ 2 + ((y - 28) / 8::DOUBLE) ^ 2 <= 1 UNION ALL SELECT 1, x, y FROM p WHERE x BETWEEN 20 AND 39 AND y BETWEEN 20 AND 35),
      d AS (SELECT r, dx, dy FROM (SELECT unnest(range(0, 7)) AS r), (SELECT unnest(range(-6, 7)) AS dx), (SELECT unnest(range(-6, 7)) AS dy) WHERE dx * dx + dy * dy <= r * r),
      n AS (SELECT shape, r, count(DISTINCT (x + dx) * 64 + y + dy) AS n FROM m, d WHERE x + dx BETWEEN 0 AND 63 AND y + dy BETWEEN 0 AND 63 GROUP BY shape, r)
      SELECT vec_id, n AS masked, CASE WHEN vec_id % 256 = 128 THEN 0 ELSE n END AS changed FROM embeddings JOIN n ON shape = vec_id % 2 AND r = vec_id % 7"""),
    "temporal_stream_sessions": (temporal_stream_sessions, f"WITH {_SESS}, z AS (SELECT user_id AS file, min(epoch_us(ts)) AS t0 FROM events GROUP BY 1) SELECT sess.file, topic, a + t0 AS a, b + t0 AS b, n FROM sess JOIN z ON z.file = sess.file"),
}
QUERIES = {k: f for k, (f, _) in _PAIRS.items()}
ORACLES = {k: s for k, (_, s) in _PAIRS.items() if s}
