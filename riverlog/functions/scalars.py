"""Small expressions over frames, grids, names and run parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edges of the detector's input; saturation and value of a tint, and how many hues there are; the most feeds that stand in two
#: columns: fixed values.
SHORT_EDGE, LONG_EDGE = 1200, 1200
TINT_SATURATION, TINT_VALUE, HUES = 200, 230, 180
FEW_FEEDS = 4


def seconds(ns: Column) -> Column:
    """For people to read: nanoseconds beyond 2 ** 53 lose their last digits, so nothing is joined on it."""
    return ns.cast("double") / 1e9


def even(x: Column) -> Column:
    """Rounded to a whole number, halves to the even one, then down to an even one."""
    return (F.floor(F.bround(x) / 2) * 2).cast("int")


def detector_size(w: Column, h: Column, short: int = SHORT_EDGE, long: int = LONG_EDGE) -> Column:
    """struct<w, h>: the short edge brought to `short`, then the long one down to `long` at most; halves go up."""
    by = F.lit(float(short)) / F.least(w, h)
    wide, high = w * by, h * by
    most = F.greatest(wide, high)
    down = F.when(most > long, F.lit(float(long)) / most).otherwise(F.lit(1.0))
    whole = lambda x: F.floor(x * down + 0.5).cast("int")
    return F.struct(whole(wide).alias("w"), whole(high).alias("h"))


def rotation(degrees: Column) -> Column:
    """0, 90, 180 or 270."""
    return F.pmod(F.bround(degrees / 90.0).cast("int") * 90, F.lit(360))


def displayed_size(w: Column, h: Column, turned: Column) -> Column:
    """struct<w, h> after a rotation."""
    side = turned.isin(90, 270)
    return F.struct(F.when(side, h).otherwise(w).alias("w"), F.when(side, w).otherwise(h).alias("h"))


def grid(feeds: Column, tile_width: int, w: Column, h: Column) -> Column:
    """struct<cols, rows, tile_height>: three columns for more than four feeds, else two."""
    cols = F.when(feeds > FEW_FEEDS, 3).otherwise(2)
    return F.struct(cols.alias("cols"), F.ceil(feeds / cols).cast("int").alias("rows"), even(F.lit(float(tile_width)) * h / w).alias("tile_height"))


def display_name(topic: Column) -> Column:
    return F.replace(F.btrim(topic, F.lit("/")), F.lit("/video"), F.lit(""))


def tint(seed: Column) -> Column:
    """struct<hue, b, g, r>: a colour that a name always gets; hues go from 0 to 179."""
    hue = (F.conv(F.substring(F.sha2(seed, 256), 1, 4), 16, 10).cast("int") % HUES).cast("int")
    sector, part = F.floor(hue / 30).cast("int"), (hue % 30) / 30.0
    high, share = float(TINT_VALUE), TINT_SATURATION / 255.0
    low, falling, rising = F.lit(high * (1 - share)), high * (1 - share * part), high * (1 - share * (1 - part))
    # Which of the four levels blue, green and red have in each of the six sectors of the circle.
    order = {"b": (low, low, rising, F.lit(high), F.lit(high), falling), "g": (rising, F.lit(high), F.lit(high), falling, low, low), "r": (F.lit(high), falling, low, low, rising, F.lit(high))}
    level = lambda c: F.bround(F.get(F.array(*order[c]), sector)).cast("int").alias(c)
    return F.struct(hue.alias("hue"), level("b"), level("g"), level("r"))


def utc_now() -> Column:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def parameters(values: dict) -> Column:
    """A run's parameters as map<string, string>; None stays null."""
    pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (str(k), None if v is None else str(v))]
    return F.create_map(*pairs).cast("map<string,string>") if pairs else F.create_map().cast("map<string,string>")


def is_system_log(name: Column) -> Column:
    return F.startswith(name, F.lit("system_logs_"))


def parse_device(text: str) -> tuple[str, int | None]:
    """"cpu", "1" or "cuda:1" -> (name, number); anything else is an error."""
    name = text.strip().lower()
    number = name.removeprefix("cuda:")
    if name == "cpu":
        return name, None
    if not number.isdecimal():
        raise ValueError(f"no device {text!r}: cpu, a number or cuda:number")
    return f"cuda:{number}", int(number)
