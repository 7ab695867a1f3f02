"""Manifests and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(prior: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """prior without new's keys, and new."""
    return prior.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def bind(sources: DataFrame, reports: DataFrame, key: str, duration: str, min_keep: int) -> DataFrame:
    """Each source with exactly one status: ok, too_short, or no_report; nothing unexamined passes as clean."""
    met = sources.join(reports, key, "left")
    return met.withColumn("status", F.when(F.col(duration).isNull(), "no_report").when(F.col(duration) < min_keep, "too_short").otherwise("ok"))


def balance(sizes: list[tuple[str, int]], buckets: int) -> list[list[str]]:
    """Largest first into the lightest bucket, the first if equal: a driver-side list of files, not data."""
    load, out = [0] * buckets, [[] for _ in range(buckets)]
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        i = min(range(buckets), key=lambda k: (load[k], k))
        load[i] += size
        out[i].append(name)
    return out
