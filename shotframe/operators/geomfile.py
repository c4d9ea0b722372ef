"""Detector geometry as text: panels of a geometry file as rows, and rows as a file. One line is key = value or
panel/key = value; what follows a semicolon is a comment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The variable that has a detector's camera length, by the detector's name and the instrument's.
CAMERA_LENGTHS = (
    ("epix10k2m", "mfx", "MFX:ROB:CONT:POS:Z"),
    ("epix10ka2m", "mfx", "MFX:ROB:CONT:POS:Z"),
    ("jungfrau4m", "cxi", "CXI:DS1:MMS:06.RBV"),
    ("rayonix", "mfx", "MFX:DET:MMS:04.RBV"),
)
#: Keys of a panel in the order in which a file has them: the pixels it takes, its corner, its axes and its place along the beam.
WHOLE = ("min_fs", "max_fs", "min_ss", "max_ss")
PLACE = ("corner_x", "corner_y", "res", "coffset")
AXES = ("fs", "ss")


def camera_length_of(name: Column) -> Column:
    """The variable with the camera length of a detector called so; an error at run time if none is known."""
    low = F.lower(name)
    found = F.coalesce(*(F.when(low.contains(d) & low.contains(i), F.lit(pv)) for d, i, pv in CAMERA_LENGTHS))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no camera length is known of "), name)))


def camera_offset(distance: Column, camera_length: Column) -> Column:
    """Metres that a panel lies behind the camera length, both in millimetres."""
    return (distance - camera_length) / 1000.0


def entries(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, panel, key, value) of the lines that set something; panel is null for the whole detector."""
    text = F.trim(F.substring_index(line, ";", 1))
    value = F.trim(F.expr("substring(_t, instr(_t, '=') + 1)"))
    rows = lines.select(*keep, text.alias("_t")).where(F.contains("_t", F.lit("=")))
    rows = rows.select(*keep, F.trim(F.substring_index("_t", "=", 1)).alias("_l"), value.alias("value"))
    panel = F.when(F.contains("_l", F.lit("/")), F.substring_index("_l", "/", 1))
    return rows.select(*keep, panel.alias("panel"), F.substring_index("_l", "/", -1).alias("key"), "value")


def axis(text: Column) -> Column:
    """(x, y) of an axis written as +0.9x -0.1y; a part that is missing is 0."""
    bare = F.regexp_replace(text, " ", "")
    part = lambda c: F.coalesce(F.regexp_extract(bare, rf"([+-]?[0-9.]*(?:[eE][+-]?[0-9]+)?){c}", 1).try_cast("double"), F.when(bare.rlike(rf"-{c}"), -1.0).when(bare.contains(c), 1.0).otherwise(0.0))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def panels(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each panel of a geometry file (of keep): panel, its pixels, corner, res, coffset, and axes fs and ss as (x, y). A
    key that a panel does not set is the one set for the whole detector; of repeated lines any one counts. Values are numbers before
    they are aggregated, as texts would be sorted: all lines of a task."""
    number = F.when(F.col("key").isin(*WHOLE, *PLACE), F.col("value").cast("double"))
    pair = F.when(F.col("key").isin(*AXES), axis(F.col("value")))
    e = entries(lines, line, keep).select(*keep, "panel", "key", number.alias("_n"), pair.alias("_p"), F.xxhash64("value").alias("_h"))
    of = lambda k, c: F.when(F.col("key") == k, F.col(c))
    parts = {f"{k}_{c}": F.max_by(of(k, f"_p.{c}"), of(k, "_h")) for k in AXES for c in ("x", "y")}  # both of the same line
    values = {k: F.max(of(k, "_n")) for k in (*WHOLE, *PLACE)} | parts
    own = e.where("panel is not null and panel not like 'bad%' and panel not like 'rigid%'").groupBy(*keep, "panel").agg(*(v.alias(k) for k, v in values.items()))
    top = e.where("panel is null").groupBy(*keep).agg(*(v.alias(f"top_{k}") for k, v in values.items()))
    both = own.join(top, list(keep), "left") if keep else own.crossJoin(F.broadcast(top))  # top: one row
    value = lambda k: F.coalesce(k, f"top_{k}")
    axes = [F.struct(*(F.coalesce(value(f"{k}_{c}"), F.lit(0.0)).alias(c) for c in ("x", "y"))).alias(k) for k in AXES]
    return both.select(*keep, "panel", *(value(k).cast("long").alias(k) for k in WHOLE), *(value(k).alias(k) for k in PLACE), *axes)


def geometry_lines(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, panel, line_no, line) of panels as panels() gives them, ready to be written in order."""
    number = lambda c: F.expr(f"format_number({c}, '0.000000')")
    signed = lambda c: F.expr(f"format_number({c}, '+0.000000;-0.000000')")
    lines = [F.concat(F.col("panel"), F.lit(f"/{k} = "), F.col(k).cast("string")) for k in WHOLE]
    lines += [F.concat(F.col("panel"), F.lit(f"/{k} = "), number(k)) for k in PLACE]
    lines += [F.concat(F.col("panel"), F.lit(f"/{k} = "), signed(f"{k}.x"), F.lit("x "), signed(f"{k}.y"), F.lit("y")) for k in AXES]
    return rows.select(*keep, "panel", F.posexplode(F.array(*lines)).alias("line_no", "line"))


def pixel_places(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, panel, fs, ss, x, y) of every pixel's corner, in pixels: a panel's corner and as many steps along its axes."""
    steps = rows.select(*keep, "panel", "min_fs", "max_fs", "corner_x", "corner_y", F.col("fs").alias("_f"), F.col("ss").alias("_s"), F.explode(F.sequence("min_ss", "max_ss")).alias("ss"), "min_ss")
    cells = steps.select("*", F.explode(F.sequence("min_fs", "max_fs")).alias("fs"))
    a, b = F.col("fs") - F.col("min_fs"), F.col("ss") - F.col("min_ss")
    return cells.select(*keep, "panel", "fs", "ss", *((F.col(f"corner_{c}") + a * F.col(f"_f.{c}") + b * F.col(f"_s.{c}")).alias(c) for c in ("x", "y")))
