"""Detection reports and run manifests as nested rows: building, writing, reading, and what is summed up from them.

A report document has the times of the logs in seconds, as doubles; here they are LONG microseconds. A recording is one element of
`files`, so a row holds one recording's detections at most.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.operators import intervals as spans_of
from riverlog.operators import manifest

#: Names in a report document: fixed values.
DETECTION = "struct<frame:int,log_time:double,t_rel_s:double,boxes:array<array<double>>>"
CHANNEL = f"struct<topic:string,codec:string,messages:long,frames_checked:long,frames_with_faces:long,start_log_time:double,end_log_time:double,intervals_rel_s:array<array<double>>,detections:array<{DETECTION}>>"
FILE = f"struct<file:string,status:string,error:string,log_start_time:double,duration_s:double,frames_with_faces_total:long,union_face_time_s:double,channels:array<{CHANNEL}>>"
REPORT = f"schema string, created_utc string, script_version string, params map<string,string>, files array<{FILE}>"


def micros(seconds: Column) -> Column:
    return F.round(seconds * 1_000_000).cast("long")


def _seconds(us: Column) -> Column:
    return us / 1_000_000.0


def build_report(channels: DataFrame, spans: DataFrame, detections: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row (files array<FILE>) for each row of statuses(file, status, error).

    channels(file, topic, codec, messages, checked, start, end), spans(file, topic, a, b) relative to the channel's start, and
    detections(file, topic, frame, t, boxes), with microseconds. A recording whose status is not "ok" has no channels.
    """
    on = ["file", "topic"]
    pair = F.array(_seconds(F.col("a")), _seconds(F.col("b")))
    each = spans.groupBy(*on).agg(F.array_sort(F.collect_list(pair)).alias("intervals_rel_s"))
    seen = detections.join(channels.select(*on, "start"), on).groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("frame", _seconds(F.col("t")).alias("log_time"), _seconds(F.col("t") - F.col("start")).alias("t_rel_s"), "boxes"))).alias("detections"))
    full = channels.join(each, on, "left").join(seen, on, "left")
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    hits = F.coalesce(F.size("detections"), F.lit(0))
    count = F.when(F.col("detections").isNull(), 0).otherwise(hits).cast("long")
    channel = F.struct("topic", "codec", "messages", F.col("checked").alias("frames_checked"), count.alias("frames_with_faces"), _seconds(F.col("start")).alias("start_log_time"), _seconds(F.col("end")).alias("end_log_time"), none("intervals_rel_s", "array<array<double>>"), none("detections", f"array<{DETECTION}>"))
    files = full.groupBy("file").agg(F.array_sort(F.collect_list(channel)).alias("channels"), F.min("start").alias("t0"), F.max("end").alias("t1"), F.sum(count).alias("hits"))
    whole = on_one_axis(channels, spans)
    time = spans_of.union(whole, ["file"]).groupBy("file").agg(F.sum(F.col("b") - F.col("a")).alias("covered"))
    met = statuses.join(files, "file", "left").join(time, "file", "left")
    ok = F.col("status") == "ok"
    row = F.struct(F.col("file").cast("string").alias("file"), "status", "error", F.when(ok, _seconds(F.col("t0"))).alias("log_start_time"), F.when(ok, _seconds(F.col("t1") - F.col("t0"))).alias("duration_s"), F.when(ok, F.coalesce("hits", F.lit(0))).alias("frames_with_faces_total"), F.when(ok, _seconds(F.coalesce("covered", F.lit(0)))).alias("union_face_time_s"), F.when(ok, F.col("channels")).cast(f"array<{CHANNEL}>").alias("channels"))
    return met.select(F.array(row).alias("files"))


def on_one_axis(channels: DataFrame, spans: DataFrame) -> DataFrame:
    """file, topic, a, b relative to the recording's start, from spans relative to each channel's."""
    starts = channels.groupBy("file").agg(F.min("start").alias("t0"))
    moved = channels.select("file", "topic", "start").join(starts, "file").select("file", "topic", (F.col("start") - F.col("t0")).alias("off"))
    return spans.join(moved, ["file", "topic"]).select("file", "topic", (F.col("a") + F.col("off")).alias("a"), (F.col("b") + F.col("off")).alias("b"))


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document a line."""
    report.write.json(path)


def read_report(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row for each recording of the documents at path (one document a file, or one a line); broken JSON is an error."""
    return spark.read.schema(REPORT).option("multiLine", not lines).option("mode", "FAILFAST").json(path).select(F.inline("files"))


def usable(files: DataFrame) -> DataFrame:
    return files.where("status = 'ok'")


def channels(files: DataFrame) -> DataFrame:
    """One row for each channel of usable recordings, with start, end and the recording's start t0 in microseconds."""
    c = usable(files).select("file", micros(F.col("log_start_time")).alias("t0"), F.explode("channels").alias("c"))
    return c.select("file", "t0", micros(F.col("c.start_log_time")).alias("start"), micros(F.col("c.end_log_time")).alias("end"), "c.*").drop("start_log_time", "end_log_time")


def intervals(files: DataFrame) -> DataFrame:
    """file, topic, a, b: detected stretches of all channels, relative to the recording's start."""
    s = channels(files).select("file", "topic", (F.col("start") - F.col("t0")).alias("off"), F.explode("intervals_rel_s").alias("s"))
    return s.select("file", "topic", (F.col("off") + micros(F.get("s", F.lit(0)))).alias("a"), (F.col("off") + micros(F.get("s", F.lit(1)))).alias("b"))


def detections(files: DataFrame) -> DataFrame:
    """file, topic, frame, t, boxes."""
    return channels(files).select("file", "topic", F.inline("detections")).select("file", "topic", "frame", micros(F.col("log_time")).alias("t"), "boxes")


def without_detections(files: DataFrame) -> DataFrame:
    return files.withColumn("channels", F.transform("channels", lambda c: c.dropFields("detections")))


def nearby(found: DataFrame, cell: int) -> DataFrame:
    """topic, t (nearest multiple of `cell`, halves up), boxes: those of all recordings at one time of a topic."""
    at = (F.floor((F.col("t") + cell // 2) / cell) * cell).cast("long")
    return found.groupBy("topic", at.alias("t")).agg(F.flatten(F.collect_list("boxes")).alias("boxes"))


def report_summary(files: DataFrame) -> DataFrame:
    """One row: recordings by status, those with detections, their frames, and microseconds of detections and of video."""
    ok, hits = F.col("status") == "ok", F.col("frames_with_faces_total")
    total = lambda x: F.coalesce(F.sum(F.when(ok, x)), F.lit(0))
    return files.agg(F.count("*").alias("files"), F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "skipped").alias("skipped_no_video"), F.count_if(~F.col("status").isin("ok", "skipped")).alias("error"), F.count_if(ok & (hits > 0)).alias("files_with_faces"), total(hits).alias("frames_with_faces"), total(micros(F.col("union_face_time_s"))).alias("face_time"), total(micros(F.col("duration_s"))).alias("video_time"))


def file_rollup(messages: DataFrame, by: list[str], topic: str, t: str, codec: str) -> DataFrame:
    """Per recording: channels, messages, start, duration, the shortest channel's messages, the fastest channel's frames a second in
    millionths, and the formats seen in all channels."""
    span = F.max(t) - F.min(t)
    one = messages.groupBy(*by, topic).agg(F.count("*").alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"), span.alias("span"), F.collect_set(codec).alias("formats"))
    rate = F.when((F.col("n") > 1) & (F.col("span") > 0), F.floor((F.col("n") - 1) * 1e6 / F.col("span") * 1e6))
    return one.groupBy(*by).agg(F.count("*").alias("channels"), F.sum("n").alias("messages"), F.min("lo").alias("start_t"), (F.max("hi") - F.min("lo")).alias("duration"), F.min("n").alias("shortest"), F.max(rate).alias("fps_millionths"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("formats")))).alias("formats"))


def run_summary(records: DataFrame, status: str, kinds: list[str], total: str) -> DataFrame:
    """One row: records, those of each status, and the sum of a count."""
    return records.agg(F.count("*").alias("files"), *[F.count_if(F.col(status) == k).alias(k) for k in kinds], F.coalesce(F.sum(total), F.lit(0)).alias(total))


def cut_summary(clips: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """One row over all recordings: how many, their clips, microseconds kept and in all."""
    per = clips.groupBy(*by).agg(F.count("*").alias("clips"), F.sum(F.col("b") - F.col("a")).alias("kept"))
    return bounds.join(per, by, "left").agg(F.count("*").alias("files"), F.coalesce(F.sum("clips"), F.lit(0)).alias("clips"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"), F.coalesce(F.sum("duration"), F.lit(0)).alias("source"))


def first_spans(spans: DataFrame, by: list[str], n: int = 4) -> DataFrame:
    """by, shown ("a-b, a-b, ..."), more (how many are not shown), for people to read. A group's spans are one row here."""
    every = F.array_sort(F.collect_list(F.struct("a", "b")))
    text = F.array_join(F.transform(F.slice("every", 1, n), lambda s: F.format_string("%d-%d", s["a"], s["b"])), ", ")
    return spans.groupBy(*by).agg(every.alias("every")).select(*by, text.alias("shown"), F.greatest(F.lit(0), F.size("every") - n).alias("more"))


def write_manifest(spark: SparkSession, path: str, document: dict) -> None:
    """A small document of a run, written aside and renamed: readers see the old one or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    fs = to.getFileSystem(conf)
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(document, indent=2, sort_keys=True, default=str).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), conf)
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = overwrite
    files.rename(fs.makeQualified(part), fs.makeQualified(to), kinds)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The document, or None where there is none. One that can't be read is an error: it is not replaced by an empty one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return None
    rows = spark.read.text(path, wholetext=True).collect()  # one small document
    return json.loads(rows[0]["value"])


def cut_records(targets: DataFrame, messages: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """A manifest's record of each recording of bounds(by, duration): kept, removed (of the written logs, which may overlap), kept_ppm,
    and its logs, clips and removed, as array<struct<name, a, b, duration, messages>> by a; from targets(by, kind, name, a, b) and
    messages(name, messages). A recording without logs has empty arrays; a log without messages counts 0."""
    log = F.struct("a", "b", "name", (F.col("b") - F.col("a")).alias("duration"), F.coalesce("messages", F.lit(0)).cast("long").alias("messages"))
    each = targets.join(messages, "name", "left").groupBy(*by).agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, log))).alias(n) for k, n in (("clip", "clips"), ("removed", "gone"))])
    met = bounds.join(each, by, "left")
    logs = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: F.struct(x["name"].alias("name"), x["a"].alias("a"), x["b"].alias("b"), x["duration"].alias("duration"), x["messages"].alias("messages")))
    total = lambda c: F.aggregate(F.coalesce(c, F.array()), F.lit(0).cast("long"), lambda n, x: n + x["duration"])
    share = F.when(F.col("duration") > 0, F.floor(total("clips") * 1_000_000 / F.col("duration"))).otherwise(0)
    return met.select(*by, "duration", total("clips").alias("kept"), total("gone").alias("removed"), share.cast("long").alias("kept_ppm"), logs("clips").alias("clips"), logs("gone").alias("removed_logs"))


def blur_records(channels: DataFrame, by: list[str]) -> DataFrame:
    """A manifest's record of each recording: frames, frames_with_faces and channels map<topic, struct<frames, frames_detected,
    frames_with_faces, boxes, max_box_px>> from frames channels(by, topic, detected boolean, boxes array<struct<x1, y1, x2, y2, ...>>).

    A box's size is its longer side in whole pixels; null boxes are none."""
    side = F.array_max(F.transform("boxes", lambda b: F.greatest(b["x2"].cast("int") - b["x1"].cast("int"), b["y2"].cast("int") - b["y1"].cast("int"))))
    n = F.coalesce(F.size("boxes"), F.lit(0))
    n = F.when(F.col("boxes").isNull(), 0).otherwise(n)
    one = channels.groupBy(*by, "topic").agg(F.count("*").alias("frames"), F.count_if("detected").alias("frames_detected"), F.count_if(n > 0).alias("frames_with_faces"), F.sum(n).cast("long").alias("boxes"), F.coalesce(F.max(side), F.lit(0)).alias("max_box_px"))
    figures = F.struct("frames", "frames_detected", "frames_with_faces", "boxes", "max_box_px")
    return one.groupBy(*by).agg(F.sum("frames").alias("frames"), F.sum("frames_with_faces").alias("frames_with_faces"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("topic"), figures)))).alias("channels"))


def merged_manifest(prior: DataFrame, prior_short: DataFrame, new: DataFrame, short: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(records, too short ones) after a run: a recording of this run replaces its prior record; one that was too short before and was cut
    now is too short no more, one that is too short now keeps its prior record of an earlier cut."""
    seen = short.select(key).union(new.select(key)).distinct()
    return manifest.upsert(prior, new, key), prior_short.join(seen, key, "left_anti").unionByName(short)
