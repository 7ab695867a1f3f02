"""Registered queries over frames, streams, containers, files and manifests, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.functions import video, wire
from riverlog.operators import boxes, detect, joins, mosaic, reports
from riverlog.plans import catalog
from riverlog.plans.catalog import BY, CHANNEL, CONF, HOUR, _bounds, _events, _mapped, _relative, _stored, _table, _targets
from riverlog.sources import files, mcap_source
from riverlog.sources.folders import file_system, scratch


def _pixels(values: list[float], scale: float = 1500.0) -> np.ndarray:
    """An embedding of n * n numbers as a grey level each: floor(|x| * scale), 255 at most."""
    n = int(len(values) ** 0.5)
    return np.minimum(255, np.floor(np.abs(np.array(values, float)) * scale)).astype(np.uint8)[: n * n].reshape(n, n)


def stream_probe(spark, sf_dir):
    """A camera for each part, its parameter set in one of its first eleven messages; those beyond the eighth are not looked at."""
    mcap_source.register(spark)
    kind = pa.schema([("name", pa.string()), ("topic", pa.string()), ("log_time", pa.int64()), ("data", pa.binary())])

    def message(codec: str, sps: bytes = b"") -> bytes:
        return wire.encode({3: wire.DELIMITER + b"\xf0" + sps + b"\x00\x00\x01\x41x", 4: codec.encode()})

    plain = {codec: message(codec) for codec in ("h264", "h265")}

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                rows = []
                for i, size in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    codec, name, topic = "h265" if i % 2 else "h264", f"parts{i // 1000}", f"/cam/{i}"
                    sps = video.parameter_set(2 * (16 + 7 * size + i % 3), 2 * (40 + i % 500), codec)
                    rows += [(name, topic, k, message(codec, sps) if k == i % 11 else plain[codec]) for k in range(11)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    made = _table(spark, sf_dir, "part").select("p_partkey", "p_size").mapInArrow(packets, "name string, topic string, log_time long, data binary")
    path = scratch(spark, "streams")
    made = made.withColumn("schema_name", F.lit(mcap_source.VIDEO)).withColumn("message_encoding", F.lit("protobuf"))
    made.repartition("name").sortWithinPartitions("name", "log_time").write.format("mcap").option("split", "name").mode("append").save(path)
    return mcap_source.stream_sizes(spark, path).select(F.substring("topic", 6, 20).cast("long").alias("p_partkey"), "codec", "width", "height")


def _written(rows: DataFrame, path: str, content: Callable[..., bytes]) -> None:
    """A file for each row, named by its first column, of content(other columns)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        fs.create_dir(root, recursive=True)
        for b in batches:
            for name, *values in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_output_stream(f"{root}/{name}") as out:
                    out.write(content(*values))
            yield b.select([0])

    rows.toDF("name", *[f"value{i}" for i in range(1, len(rows.columns))]).mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def container_probe(spark, sf_dir):
    """A container file for each supplier, with media that the probe skips."""
    path = scratch(spark, "containers")
    rows = _table(spark, sf_dir, "supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".mp4")), "s_suppkey", "s_nationkey")
    _written(rows, path, lambda i, n: files.container(16 * (n + 1), 2 * (i % 700 + 1), 90 * (i % 4), 100 + i, 1000 * (1 + n % 3), 5000 + i, media=100_000))
    got = files.probe_containers(spark, path)
    return got.select(F.replace("file", F.lit(".mp4"), F.lit("")).cast("long").alias("s_suppkey"), "status", "codec", "width", "height", "rotation", "frames", F.floor(F.col("fps") * 1000).alias("fps_thousandths"))


def file_digests(spark, sf_dir):
    """The texts of a hundred ids as a file, and what the files' bytes add up to."""
    path = scratch(spark, "files")
    texts = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    rows = _table(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 100").alias("part")).agg(texts.alias("t")).select(F.col("part").cast("string").alias("name"), F.array_join(F.transform("t", lambda x: F.coalesce(x["text"], F.lit(""))), "").alias("text"))
    _written(rows, path, lambda text: text.encode())
    return files.digest_files(spark, path).select(F.col("file").cast("long").alias("part"), "bytes", "sha256")


def record_kinds(spark, sf_dir):
    """Records in logs of one user each, up to the end of the data; chunks are opened. Not those whose number is the writer's choice."""
    mcap_source.register(spark)
    path = scratch(spark, "logs")
    rows = _events(spark, sf_dir).select(F.col("file").cast("string").alias("name"), "topic", F.lit("event").alias("schema_name"), (F.col("t") * 1000).alias("log_time"), F.col("event_id").alias("sequence"), F.col("topic").cast("binary").alias("data"))
    rows.repartition("name").sortWithinPartitions("name", "log_time").write.format("mcap").option("split", "name").option("compression", "lz4").mode("append").save(path)
    got = spark.read.format("mcap").option("records", "records").option("payload", "false").load(path).where("kind <> 'message_index'")
    return got.groupBy("kind", F.coalesce("topic", F.lit("")).alias("topic")).agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))


def mcap_lz4(spark, sf_dir):
    """Logs with LZ4 chunks, written and read by topic and time."""
    mcap_source.register(spark)
    path = scratch(spark, "lz4")
    rows = _events(spark, sf_dir).select("topic", (F.col("t") * 1000).alias("log_time"), F.col("event_id").alias("sequence"), F.col("value").cast("string").cast("binary").alias("data"))
    rows.repartitionByRange(4, "log_time").sortWithinPartitions("log_time").write.format("mcap").option("compression", "lz4").mode("append").save(path)
    got = spark.read.format("mcap").load(path).where("topic IN ('click', 'view') AND log_time > 1704500000000000000")
    return got.select(F.col("sequence").alias("event_id"), "topic", F.col("data").cast("string").cast("double").alias("value"))


def _mixed_logs(spark, sf_dir) -> str:
    """Logs of users: of every third without video, of every fifth broken, with the user's own number in it."""
    mcap_source.register(spark)
    path = scratch(spark, "mixed")
    e = _events(spark, sf_dir).where("file % 5 <> 0")
    rows = e.select(F.col("file").cast("string").alias("name"), "topic", F.when(F.col("file") % 3 == 0, "imu").otherwise(mcap_source.VIDEO).alias("schema_name"), F.col("t").alias("log_time"))
    rows.repartition("name").sortWithinPartitions("name", "log_time").write.format("mcap").option("split", "name").mode("append").save(path)
    broken = _events(spark, sf_dir).where("file % 5 = 0").select("file").distinct()
    _written(broken.select(F.concat(F.col("file").cast("string"), F.lit(".mcap")), "file"), path, lambda i: b"not a log %d" % i)
    return path


def scan_status(spark, sf_dir):
    return mcap_source.scan_status(spark, _mixed_logs(spark, sf_dir)).select(_user(), "status", F.col("reason").isNotNull().alias("has_reason"))


def pass_through(spark, sf_dir):
    """What is copied, and what the target holds: digests of the copies, and of the broken logs by their bytes."""
    target = scratch(spark, "passed")
    got = mcap_source.pass_through(spark, _mixed_logs(spark, sf_dir), target)
    there = files.digest_files(spark, target).select("file", F.col("sha256").alias("there"))
    met = got.join(there, "file", "left")
    return met.select(_user(), "status", F.coalesce(F.col("sha256") == F.col("there"), F.lit(False)).alias("copied"), F.when(F.col("status") == "copied_unscanned", F.col("there")).alias("digest"))


def _user():
    return F.replace("file", F.lit(".mcap"), F.lit("")).cast("long").alias("file")


def topic_order(spark, sf_dir):
    """Each recording's topics in order, and the recordings' own order by name."""
    one = _events(spark, sf_dir).groupBy("file").agg(F.array_join(F.array_sort(F.collect_set("topic")), ",").alias("topics"))
    return one.orderBy(F.col("file").cast("string")).select("file", "topics")


def mosaic_compose(spark, sf_dir):
    """Embeddings as frames of four feeds, every seventh missing, in one picture for each four ids."""
    def frame(i, v):
        return i // 4, i % 4, 8, 8, np.repeat(_pixels(v)[:, :, None], 3, 2).tobytes() if i % 7 else None

    rows = _table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64).select("vec_id", "embedding")
    kinds = pa.schema([("tick", pa.int64()), ("slot", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("pixels", pa.binary())])

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [frame(i, v) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*each), kinds)] if each else [pa.array([], k.type) for k in kinds], schema=kinds)

    made = rows.mapInArrow(frames, "tick long, slot long, height int, width int, pixels binary")
    got = mosaic.compose(made, ["tick"], "slot", 4, 2, (4, 4))
    return _mapped(got.select("tick", "height", "width", "pixels"), lambda t, h, w, p: (t, h, w, int(np.frombuffer(p, np.uint8).astype(int).sum())), "tick long, height int, width int, total long")


def dilate_quarter(spark, sf_dir):
    """Masks of an embedding's large numbers, grown at a quarter of the resolution."""
    def one(i, v):
        mask = np.zeros((32, 32), np.uint8)
        for k, x in enumerate(v[:64]):
            if x > 0.15:
                mask[4 * (k // 8) + k % 3, 4 * (k % 8) + k % 2] = 1
        return i, int(boxes.dilate(mask, 8 + i % 5, coarse=True).sum())

    return _mapped(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), one, "vec_id long, masked long")


def fill_modes(spark, sf_dir):
    """An embedding as a frame of 8 x 8, filled in its right half in each way."""
    def one(i, v):
        grey = _pixels(v)
        frame, mask = np.stack([grey, grey, grey], 2), np.zeros((8, 8), np.uint8)
        mask[:, 4:] = 1
        sums = []
        for mode in ("grey", "pixelate", "blur", "anon"):
            out = boxes.fill(frame, mask, mode, 128, 4, (255, 255, 255)).astype(int)
            assert (out[:, :4] == frame[:, :4]).all()
            sums.append(int(out[:, 4:, 0].sum()))
        return i, *sums

    rows = _table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64).select("vec_id", "embedding")
    return _mapped(rows, one, "vec_id long, grey long, pixelate long, blur long, anon long")


def colour_reject(spark, sf_dir):
    """An embedding as the colours of 62 pixels, each four times, in a box that is kept unless too much of it is blue."""
    def one(i, v):
        levels = np.floor(np.abs(np.array(v[:64], float)) * 1500).astype(int) % 256
        frame = np.repeat(np.stack([levels[:62], levels[1:63], levels[2:64]], 1)[None].astype(np.uint8), 4, 0)
        return i, len(boxes.without_coloured(frame, np.array([[-3.0, -3.0, 70.0, 9.0, 0.9]]), 0.25))

    rows = _table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64).select("vec_id", "embedding")
    return _mapped(rows, one, "vec_id long, kept long")


def cut_manifest(spark, sf_dir):
    """Each recording's record with its logs, as text."""
    rel = _relative(spark, sf_dir)
    targets = _stored(_targets(spark, sf_dir), "targets")
    counted = joins.route(rel.select("file", "t"), targets.select("file", "name", "a", "b"), BY, cell=HOUR).groupBy("name").agg(F.count("*").alias("messages"))
    got = reports.cut_records(targets, counted, _bounds(spark, sf_dir), BY)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.format_string("%s %d-%d %d", x["name"], x["a"], x["b"], x["messages"])), ", ").alias(c)
    return got.select("file", "duration", "kept", "removed", "kept_ppm", text("clips"), text("removed_logs"))


def blur_manifest(spark, sf_dir):
    """Each recording's record with its channels' figures."""
    rows = detect.indexed(_relative(spark, sf_dir), CHANNEL, ["t", "event_id"])
    box = lambda i: F.struct(F.lit(1.5).alias("x1"), F.lit(0.0).alias("y1"), (F.floor(F.col("value") / 10) + 2.5 + i).alias("x2"), F.lit(9.0).alias("y2"))
    found = F.when(F.col("value") >= CONF, F.transform(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 3), box))
    got = reports.blur_records(rows.select("file", "topic", (F.col("idx") % 3 == 0).alias("detected"), F.when(F.col("idx") % 3 == 0, found).alias("boxes")), BY)
    return got.select("file", F.col("frames").alias("file_frames"), F.explode("channels").alias("topic", "c")).select("file", "file_frames", "topic", F.col("c.frames"), "c.frames_detected", "c.frames_with_faces", "c.boxes", "c.max_box_px")


def manifest_merge(spark, sf_dir):
    """Two runs over customers' orders: the first took two thirds of them and called few orders too short, the second one half and fewer."""
    n = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("file")).agg(F.count("*").alias("n"))
    first, second = n.where("file % 3 <> 0").withColumn("run", F.lit(1)), n.where("file % 2 = 0").withColumn("run", F.lit(2))
    files_, short = reports.merged_manifest(first.where("n >= 12"), first.where("n < 12"), second.where("n >= 8"), second.where("n < 8"), "file")
    return files_.withColumn("short", F.lit(False)).unionByName(short.withColumn("short", F.lit(True)))


_LEVELS = "SELECT vec_id, unnest(range(0, 64)) AS k, least(255, floor(abs(CAST(unnest(embedding) AS DOUBLE)) * 1500)) AS x FROM embeddings WHERE len(embedding) = 64"

_PAIRS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "stream_probe": (stream_probe, "SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 THEN 'hevc' ELSE 'h264' END AS codec, CASE WHEN p_partkey % 11 < 8 THEN CAST(2 * (16 + 7 * p_size + p_partkey % 3) AS INTEGER) END AS width, CASE WHEN p_partkey % 11 < 8 THEN CAST(2 * (40 + p_partkey % 500) AS INTEGER) END AS height FROM part"),
    "container_probe": (container_probe, "SELECT s_suppkey, 'ok' AS status, 'avc1' AS codec, CAST(16 * (s_nationkey + 1) AS INTEGER) AS width, CAST(2 * (s_suppkey % 700 + 1) AS INTEGER) AS height, CAST(90 * (s_suppkey % 4) AS INTEGER) AS rotation, 100 + s_suppkey AS frames, CAST(floor(CAST((100 + s_suppkey) * 1000 * (1 + s_nationkey % 3) AS DOUBLE) / (5000 + s_suppkey) * 1000) AS BIGINT) AS fps_thousandths FROM supplier"),
    "file_digests": (file_digests, "SELECT doc_id // 100 AS part, CAST(sum(octet_length(encode(coalesce(text, '')))) AS BIGINT) AS bytes, sha256(string_agg(coalesce(text, ''), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY 1"),
    "record_kinds": (record_kinds, "WITH u AS (SELECT count(DISTINCT user_id) AS n FROM events) SELECT kind, '' AS topic, n, n AS files FROM u, (SELECT unnest(['header', 'schema', 'data_end']) AS kind) UNION ALL SELECT 'channel', event_type, count(DISTINCT user_id), count(DISTINCT user_id) FROM events GROUP BY event_type UNION ALL SELECT 'message', event_type, count(*), count(DISTINCT user_id) FROM events GROUP BY event_type"),
    "mcap_lz4": (mcap_lz4, "SELECT event_id, event_type AS topic, value FROM events WHERE event_type IN ('click', 'view') AND epoch_us(ts) > 1704500000000000"),
    "topic_order": (topic_order, "SELECT user_id AS file, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS topics FROM events GROUP BY user_id"),
    "pass_through": (pass_through, "SELECT user_id AS file, CASE WHEN user_id % 5 = 0 THEN 'copied_unscanned' WHEN user_id % 3 = 0 THEN 'copied' ELSE 'scan' END AS status, user_id % 5 = 0 OR user_id % 3 = 0 AS copied, CASE WHEN user_id % 5 = 0 THEN sha256('not a log ' || user_id) END AS digest FROM events GROUP BY user_id"),
    "scan_status": (scan_status, "SELECT user_id AS file, CASE WHEN user_id % 5 = 0 THEN 'copied_unscanned' WHEN user_id % 3 = 0 THEN 'copied' ELSE 'scan' END AS status, user_id % 5 = 0 OR user_id % 3 = 0 AS has_reason FROM events GROUP BY user_id"),
    "mosaic_compose": (mosaic_compose, f"""WITH p AS ({_LEVELS}), m AS (SELECT vec_id, k // 16 AS y, k % 8 // 2 AS c, floor(sum(x) / 4 + 0.5) AS x FROM p GROUP BY ALL), f AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 24 * 16 ELSE sum(x) END AS s FROM m GROUP BY vec_id)
      SELECT vec_id // 4 AS tick, CAST(8 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width, CAST(3 * (sum(s) + 24 * 16 * (4 - count(*))) AS BIGINT) AS total FROM f GROUP BY 1"""),
    "dilate_quarter": (dilate_quarter, """WITH p AS (SELECT vec_id, 4 * (k // 8) + k % 3 AS y, 4 * (k % 8) + k % 2 AS x FROM (SELECT vec_id, unnest(range(0, len(embedding))) AS k, unnest(embedding) AS v FROM embeddings) WHERE v > 0.15 AND k < 64),
      t AS (SELECT DISTINCT vec_id, y // 4 AS y, x // 4 AS x FROM p), r AS (SELECT unnest(range(8, 13)) AS r), d AS (SELECT r, dx, dy FROM (SELECT r, CAST(ceil((r + 3 * sqrt(2)) / 4) AS BIGINT) AS q FROM r), (SELECT unnest(range(-8, 9)) AS dx), (SELECT unnest(range(-8, 9)) AS dy) WHERE dx * dx + dy * dy <= q * q),
      n AS (SELECT vec_id, count(DISTINCT (y + dy) * 8 + x + dx) * 16 AS n FROM t JOIN d ON d.r = 8 + vec_id % 5 WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7 GROUP BY vec_id) SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS masked FROM embeddings LEFT JOIN n USING (vec_id)"""),
    "fill_modes": (fill_modes, f"""WITH p AS ({_LEVELS}), s AS (SELECT vec_id, k // 32 AS y, k % 8 // 4 AS c, sum(x) / 16 AS x FROM p GROUP BY ALL),
      o AS (SELECT unnest(range(-2, 3)) AS d, unnest([1, 4, 6, 4, 1]) AS w), q AS (SELECT unnest([0, 1]) AS i),
      e AS (SELECT i, abs(i + d) % 2 AS src, sum(w) / 16.0::DOUBLE AS w FROM q, o GROUP BY ALL),
      g AS (SELECT s.vec_id, a.i AS y, b.i AS c, sum(a.w * b.w * s.x) AS x FROM s JOIN e a ON a.src = s.y JOIN e b ON b.src = s.c GROUP BY ALL),
      l AS (SELECT *, min(x) OVER (PARTITION BY vec_id) AS lo, max(x) OVER (PARTITION BY vec_id) AS hi FROM g), h AS (SELECT vec_id, y, c, x, 90 + (x - lo) * CASE WHEN hi > lo THEN 145 / (hi - lo) ELSE 0 END AS light FROM l),
      t AS (SELECT i, greatest(0, least(1, (i + 0.5::DOUBLE) / 4 - 0.5::DOUBLE)) AS f FROM (SELECT unnest(range(0, 8)) AS i)),
      b AS (SELECT h.vec_id, u.i AS y, v.i AS c, sum(CASE WHEN h.y = 0 THEN 1 - u.f ELSE u.f END * CASE WHEN h.c = 0 THEN 1 - v.f ELSE v.f END * h.x) AS x, sum(CASE WHEN h.y = 0 THEN 1 - u.f ELSE u.f END * CASE WHEN h.c = 0 THEN 1 - v.f ELSE v.f END * light) AS light FROM h, t u, t v WHERE v.i >= 4 GROUP BY ALL),
      z AS (SELECT vec_id, CAST(sum(floor(x + 0.5)) AS BIGINT) AS blur, CAST(sum(floor(light + 0.5)) AS BIGINT) AS anon FROM b GROUP BY vec_id), y AS (SELECT vec_id, CAST(sum(16 * floor(x + 0.5)) AS BIGINT) AS pixelate FROM s WHERE c = 1 GROUP BY vec_id)
      SELECT vec_id, 4096::BIGINT AS grey, pixelate, blur, anon FROM z JOIN y USING (vec_id)"""),
    "colour_reject": (colour_reject, """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 1500) AS BIGINT) % 256) AS l FROM embeddings WHERE len(embedding) = 64),
      p AS (SELECT vec_id, CAST(l[k + 1] AS DOUBLE) AS b, CAST(l[k + 2] AS DOUBLE) AS g, CAST(l[k + 3] AS DOUBLE) AS r FROM (SELECT vec_id, l, unnest(range(0, 62)) AS k FROM v)),
      m AS (SELECT *, greatest(b, g, r) AS hi, greatest(b, g, r) - least(b, g, r) AS d FROM p),
      h AS (SELECT vec_id, CASE WHEN hi > 0 THEN floor(255 * d / hi + 0.5) ELSE 0 END AS s, CAST(floor(CASE WHEN d = 0 THEN 0 WHEN hi = r THEN (g - b) / d WHEN hi = g THEN 2 + (b - r) / d ELSE 4 + (r - g) / d END * 30 + 180.5) AS BIGINT) % 180 AS hue FROM m)
      SELECT vec_id, CASE WHEN 4 * count(*) FILTER (s > 60) < 50 THEN 1 WHEN count(*) FILTER (s > 60 AND hue BETWEEN 95 AND 135) <= 0.25::DOUBLE * count(*) FILTER (s > 60) THEN 1 ELSE 0 END::BIGINT AS kept FROM h GROUP BY vec_id"""),
    "cut_manifest": (cut_manifest, f"""WITH {catalog._NAMED}, n AS (SELECT named.*, (SELECT count(*) FROM rel r WHERE r.file = named.file AND r.t BETWEEN a AND b) AS k FROM named),
      s AS (SELECT file, CAST(coalesce(sum(b - a) FILTER (kind = 'clip'), 0) AS BIGINT) AS kept, CAST(coalesce(sum(b - a) FILTER (kind = 'removed'), 0) AS BIGINT) AS removed, string_agg(name || ' ' || a || '-' || b || ' ' || k, ', ' ORDER BY a, b, name) FILTER (kind = 'clip') AS clips, string_agg(name || ' ' || a || '-' || b || ' ' || k, ', ' ORDER BY a, b, name) FILTER (kind = 'removed') AS removed_logs FROM n GROUP BY file)
      SELECT bounds.file, duration, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, CASE WHEN duration > 0 THEN CAST(floor(coalesce(kept, 0) * 1000000::DOUBLE / duration) AS BIGINT) ELSE 0 END AS kept_ppm, coalesce(clips, '') AS clips, coalesce(removed_logs, '') AS removed_logs FROM bounds LEFT JOIN s ON s.file = bounds.file"""),
    "blur_manifest": (blur_manifest, f"""WITH {catalog._REL}, i AS (SELECT *, row_number() OVER (PARTITION BY file, topic ORDER BY t, event_id) - 1 AS idx FROM rel), d AS (SELECT *, idx % 3 = 0 AS detected, CASE WHEN idx % 3 = 0 AND value >= 100 THEN event_id % 3 + 1 ELSE 0 END AS k FROM i)
      SELECT file, CAST(sum(count(*)) OVER (PARTITION BY file) AS BIGINT) AS file_frames, topic, count(*) AS frames, count(*) FILTER (detected) AS frames_detected, count(*) FILTER (k > 0) AS frames_with_faces, CAST(sum(k) AS BIGINT) AS boxes, CAST(coalesce(max(greatest(9, CAST(floor(value / 10) AS INTEGER) + k)) FILTER (k > 0), 0) AS INTEGER) AS max_box_px FROM d GROUP BY file, topic"""),
    "manifest_merge": (manifest_merge, """WITH n AS (SELECT o_custkey AS file, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT *, 1 AS run FROM n WHERE file % 3 <> 0), b AS (SELECT *, 2 AS run FROM n WHERE file % 2 = 0)
      SELECT *, false AS short FROM a WHERE n >= 12 AND file NOT IN (SELECT file FROM b WHERE n >= 8) UNION ALL SELECT *, false FROM b WHERE n >= 8 UNION ALL SELECT *, true FROM a WHERE n < 12 AND file NOT IN (SELECT file FROM b) UNION ALL SELECT *, true FROM b WHERE n < 8"""),
}
QUERIES = {k: f for k, (f, _) in _PAIRS.items()}
ORACLES = {k: s for k, (_, s) in _PAIRS.items()}
