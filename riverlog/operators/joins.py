"""As-of, band and range joins, always with an equality key; as-of by a tagged union and one window, never by pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: list[str], t: str, value: str, out: str, forward: bool = False, within: int | None = None) -> DataFrame:
    """left with `out`: value of right's row at or before (forward: at or after) t in the same group, else null."""
    rest = [c for c in left.columns if c not in by and c != t]
    a = left.select(*by, F.col(t).alias("_t"), F.struct(F.lit(True).alias("_l"), *rest).alias("_left"), F.lit(None).cast("long").alias("_rt"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_tag"))
    none = F.lit(None).cast(a.schema["_left"].dataType)
    b = right.select(*by, F.col(t).alias("_t"), none.alias("_left"), F.col(t).cast("long").alias("_rt"), F.col(value).alias("_v"), F.lit(0).alias("_tag"))
    # Looking forward is looking back in falling time. A frame from the first row to this one grows with each row; one from this row
    # to the last would be gone through anew for each.
    w = Window.partitionBy(*by).orderBy(F.col("_t").desc() if forward else F.col("_t"), "_tag").rowsBetween(Window.unboundedPreceding, 0)
    pick = F.when(F.col("_rt").isNotNull(), F.struct(F.col("_rt").alias("t"), F.col("_v").alias("v")))
    met = a.unionByName(b).withColumn("_f", F.last(pick, ignorenulls=True).over(w)).where("_left IS NOT NULL")
    near = F.col("_f.v") if within is None else F.when(F.abs(F.col("_t") - F.col("_f.t")) <= within, F.col("_f.v"))
    return met.select(*by, F.col("_t").alias(t), *[F.col(f"_left.{c}").alias(c) for c in rest], near.alias(out))


def asof_clock(rows: DataFrame, by: list[str], t: str, value: str, out: str, first: int, step: int, last: str) -> DataFrame:
    """by, k, out: for the ticks k = 0, 1, ... at first + k * step of each group, the value of its row at or before the tick, of several at
    one time the least, else null; up to k = the column `last`, the same in all rows of a group.

    Each row gives the ticks from its own time to the next row's, a group's first one also those before it: ticks are made behind the
    window and never sorted. Rows without a time show nothing, but their group has its clock.
    """
    w = Window.partitionBy(*by).orderBy(t, F.col(value).desc_nulls_first())
    begin = F.coalesce(F.greatest(F.lit(0).cast("long"), F.expr(f"(`{t}` - {first} + {step - 1}) div {step}")), F.lit(0).cast("long"))
    met = rows.withColumn("_a", begin).withColumn("_from", F.when(F.lag("_a").over(w).isNull(), 0).otherwise(F.col("_a"))).withColumn("_to", F.least(F.lead("_a").over(w) - 1, F.col(last)))
    ticks = met.where("_from <= _to").withColumn("k", F.explode(F.sequence("_from", "_to")))
    return ticks.select(*by, "k", F.when(F.col(t).isNotNull() & (F.col("k") >= F.col("_a")), F.col(value)).alias(out))


def route(messages: DataFrame, spans: DataFrame, by: list[str], t: str = "t", *, cell: int) -> DataFrame:
    """Each message with every span (a, b, and its other columns) whose closed range holds it.

    cell: a stretch of time, in t's unit, of about as many messages as a task takes. An equi-join on time cells: a span stands in each cell it touches, so a long recording is not one join key.
    A recording whose spans are long for its rows has wider cells, so that its spans stand in no more cells than it has messages and three times its spans.
    """
    whole = spans.where("b >= a")
    rows = messages.groupBy(*by).agg(F.count("*").alias("_n"))
    sizes = whole.groupBy(*by).agg(F.sum((F.col("b") - F.col("a")).cast("double")).alias("_long"), F.count("*").alias("_m")).join(rows, by)
    widths = sizes.select(*by, F.greatest(F.lit(cell), F.ceil(F.col("_long") / (F.col("_n") + F.col("_m"))).cast("long")).alias("_w"))
    of = lambda c: F.expr(f"({c} - pmod({c}, _w)) div _w")
    spread = whole.join(widths, by).withColumn("_c", F.explode(F.sequence(of("a"), of("b")))).drop("_w")
    # Spark takes an exploded table to be as small as the one before, so it might be broadcast: merged here.
    return messages.join(widths, by).withColumn("_c", of(t)).drop("_w").join(spread.hint("merge"), [*by, "_c"]).where(F.col(t).between(F.col("a"), F.col("b"))).drop("_c")


def band(left: DataFrame, right: DataFrame, by: list[str], t: str, other: str, width: int) -> DataFrame:
    """Pairs of a group no further than width apart: an equi-join on time cells of that width, right rows in three cells."""
    cell = lambda c: F.floor(F.col(c) / F.lit(max(1, width))).cast("long")
    spread = right.withColumn("_c", F.explode(F.array(*[cell(other) + d for d in (-1, 0, 1)])))
    return left.withColumn("_c", cell(t)).join(spread, [*by, "_c"]).where(F.abs(F.col(t) - F.col(other)) <= width).drop("_c")


def first_match(value: Column, rules: list[tuple[str, float]], default: float) -> Column:
    """The number of the first rule whose text stands in value."""
    out = F.lit(float(default))
    for part, number in reversed(rules):
        out = F.when(F.contains(value, F.lit(part)), F.lit(float(number))).otherwise(out)
    return out
