"""Registered queries of array files by ranges, streams of pixel blocks, droplets, photons and peaks of profiles; with the
SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.catalog import IMAGE, LEDGER, PIXELS, PROFILES, entries, gen_cfg, image, profile_shots, query, table
from shotframe.functions import nansafe as N
from shotframe.operators import droplets, geomfile, images, peaks
from shotframe.plans import lineage
from shotframe.session import shared_folder
from shotframe.sources import stacks
from shotframe.streaming import blocks, producer, reductions

# array files by ranges of shots


@query("""WITH s AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS shot, embedding FROM embeddings)
SELECT shot, round(list_sum(list_transform(embedding, lambda x: x :: DOUBLE)), 5) + 0.0 AS total, round(embedding[64] :: DOUBLE, 6) + 0.0 AS last FROM s WHERE shot >= 70 AND shot < 430""")
def stack_by_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of a range of shots from array files; the files of other columns are not opened."""
    folder = shared_folder(spark)
    stacks.write_stack(table(spark, d, "embeddings").orderBy("vec_id").select("vec_id", "label", "embedding"), folder, rows_per_part=150)
    p = stacks.read_stack(spark, folder, ["embedding"], range_bytes=16 << 10).where("shot >= 70 and shot < 430")
    p = p.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return p.select("shot", (F.round(N.array_total(F.col("embedding")), 5) + 0.0).alias("total"), (F.round(F.get("embedding", F.lit(63)), 6) + 0.0).alias("last"))


@query(f"WITH {IMAGE} SELECT r AS row, c AS col, round(coalesce(value, 0), 2) AS value FROM range(64) AS a(r) CROSS JOIN range(64) AS b(c) LEFT JOIN image ON row = r AND col = c")
def stacked_image(spark: SparkSession, d: str) -> DataFrame:
    """An assembled image kept as an array file of rows, read by ranges of rows."""
    pixels = image(spark, d).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("m"))
    rows = spark.range(64).withColumnRenamed("id", "row").join(pixels, "row", "left")  # of a detector's rows
    values = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(0.0)))
    folder = shared_folder(spark)
    stacks.write_stack(rows.orderBy("row").select(values.alias("image")), folder)
    out = stacks.read_stack(spark, folder, range_bytes=4096).select(F.col("shot").alias("row"), F.posexplode("image").alias("col", "value"))
    return out.select("row", F.col("col").cast("long").alias("col"), F.round("value", 2).alias("value"))


# streams


@query(f"WITH {PIXELS} SELECT CASE WHEN shot % 10 >= 2 THEN 'hit' ELSE 'miss' END AS kind, iy AS row, ix AS col, greatest(0, max(v)) AS value FROM pixels GROUP BY ALL")
def stream_powder_of_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Running largest values over several micro-batches, stopped half-way and gone on with from the checkpoint."""
    top = shared_folder(spark)
    raw = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice", "l_orderkey")
    for half in (0, 1):
        raw.where(F.col("l_orderkey") % 2 == half).repartition(4).write.mode("append").parquet(f"{top}/in")
        live = reductions.live_shots(spark, f"{top}/in", raw.schema, files_per_batch=2)
        p = live.select((F.col("l_suppkey") % 64).alias("row"), (F.col("l_partkey") % 64).alias("col"), F.col("l_extendedprice").alias("value"), F.col("l_orderkey").alias("shot"))
        blocks.run_to_batches(blocks.stream_powder_blocks(p, F.col("shot") % 10, side=16), f"{top}/out", f"{top}/state")
    return blocks.powder_of_batches(spark, f"{top}/out")


def _produced(spark: SparkSession, d: str) -> str:
    """A run of small images in four files, two a batch, with a stop after half of them."""
    top = shared_folder(spark)
    shots = profile_shots(spark, d).select("shot", "xray", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8))).alias("image"))
    for half in (0, 1):
        shots.where(F.col("shot") % 2 == half).repartition(4).write.mode("append").parquet(f"{top}/in")
        live = reductions.live_shots(spark, f"{top}/in", shots.schema, files_per_batch=2)
        steps = [lambda s: s.withColumn("total", N.array_total(F.flatten("image"))), lambda s: s.withColumn("brightest", F.array_max(F.transform("image", F.array_max)))]
        producer.run_producer(live, steps, f"{top}/run", f"{top}/state", {"detector": "small"}, ~F.col("xray"))
    return f"{top}/run"


@query(f"WITH {PROFILES} SELECT shot, any_value(xray) AS xray, round(sum(v), 5) + 0.0 AS total, round(max(v), 6) + 0.0 AS brightest FROM cells GROUP BY shot")
def producer_events(spark: SparkSession, d: str) -> DataFrame:
    out = producer.events_of(spark, _produced(spark, d))
    return out.select("shot", "xray", (F.round("total", 5) + 0.0).alias("total"), (F.round("brightest", 6) + 0.0).alias("brightest"))


@query(f"WITH {PROFILES} SELECT CAST(q_idx // 8 AS INTEGER) AS row, CAST(q_idx % 8 AS INTEGER) AS col, round(sum(v), 5) + 0.0 AS calib, round(sum(v) FILTER (NOT xray), 5) + 0.0 AS calib_dropped, round(sum(v * v) FILTER (NOT xray), 5) AS dropped_square FROM cells GROUP BY q_idx")
def producer_sums(spark: SparkSession, d: str) -> DataFrame:
    out = producer.sums_of(spark, _produced(spark, d))
    return out.select("row", "col", (F.round("calib", 5) + 0.0).alias("calib"), (F.round("calib_dropped", 5) + 0.0).alias("calib_dropped"), F.round("calib_dropped_square", 5).alias("dropped_square"))


# droplets


DROPS = f"""{PROFILES}, m AS (SELECT shot, (q_idx // 8) AS row, q_idx % 8 AS col, q_idx AS p, abs(v) * 100 AS v FROM cells WHERE abs(v) * 100 > 9),
r AS (SELECT shot, p AS a, p AS b FROM m UNION SELECT r.shot, r.a, n.p FROM r JOIN m AS o ON o.shot = r.shot AND o.p = r.b
      JOIN m AS n ON n.shot = r.shot AND abs(n.row - o.row) + abs(n.col - o.col) = 1),
g AS (SELECT shot, a AS p, min(b) AS droplet FROM r GROUP BY ALL),
w AS (SELECT m.*, droplet, sum(v) OVER k AS adu, max(v) OVER k AS top, count(*) OVER k AS npix FROM m JOIN g USING (shot, p) WINDOW k AS (PARTITION BY shot, droplet)),
kept AS (SELECT * FROM w WHERE top > 12 AND adu >= 30)"""


def small_images(spark: SparkSession, d: str) -> DataFrame:
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.transform(F.slice("p", i * 8 + 1, F.lit(8)), lambda v: F.abs(v) * 100))
    return profile_shots(spark, d).select("shot", rows.alias("image"))


@query(f"""WITH RECURSIVE {DROPS} SELECT shot, CAST(min(npix) AS INTEGER) AS npix, round(min(adu), 5) AS adu, round(sum(v * row) / min(adu), 5) + 0.0 AS row, round(sum(v * col) / min(adu), 5) + 0.0 AS col
FROM kept GROUP BY shot, droplet""")
def droplets_of_images(spark: SparkSession, d: str) -> DataFrame:
    found = droplets.droplets(small_images(spark, d), threshold=12.0, low=9.0, min_adu=30.0)
    one = found.select("shot", F.explode("droplets").alias("x")).select("shot", "x.*")
    return one.select("shot", "npix", *((F.round(c, 5) + 0.0).alias(c) for c in ("adu", "row", "col")))


@query(f"""WITH RECURSIVE {DROPS}, l AS (SELECT *, floor(v / 7) AS whole, v / 7 - floor(v / 7) AS rest FROM kept),
k AS (SELECT *, round(adu / 7) - sum(whole) OVER (PARTITION BY shot, droplet) AS more, row_number() OVER (PARTITION BY shot, droplet ORDER BY rest DESC, p) AS rank FROM l)
SELECT shot, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, CAST(whole + CASE WHEN rank <= more THEN 1 ELSE 0 END AS INTEGER) AS photons FROM k WHERE whole + CASE WHEN rank <= more THEN 1 ELSE 0 END > 0""")
def photons_in_droplets(spark: SparkSession, d: str) -> DataFrame:
    placed = droplets.placed_photons(small_images(spark, d), per_photon=7.0, threshold=12.0, low=9.0, min_adu=30.0)
    return placed.select("shot", F.explode("photon_places").alias("x")).select("shot", "x.*")


# images


def square_images(spark: SparkSession, d: str) -> DataFrame:
    """(shot, image): profiles as images of one panel of eight rows of eight."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8)))
    return profile_shots(spark, d).select("shot", rows.alias("image"))


@query(f"WITH {PROFILES} SELECT shot, CAST(7 - q_idx % 8 AS INTEGER) AS row, CAST(q_idx // 8 AS INTEGER) AS col, round(v, 6) + 0.0 AS value FROM cells")
def rotated_images(spark: SparkSession, d: str) -> DataFrame:
    """Turned by a right angle, where splines go through the pixels themselves."""
    turned = images.rotated(square_images(spark, d), 90.0)
    rows = turned.select("shot", F.posexplode("image").alias("row", "r")).select("shot", "row", F.posexplode("r").alias("col", "value"))
    return rows.withColumn("value", F.round("value", 6) + 0.0)


@query(f"""WITH {PROFILES}, b AS (SELECT shot, arg_max(q_idx, v) AS top FROM cells GROUP BY shot),
c AS (SELECT shot, q_idx // 8 AS row, q_idx % 8 AS col, v, abs(q_idx // 8 - top // 8) <= 1 AND abs(q_idx % 8 - top % 8) <= 1 AS inside FROM cells JOIN b USING (shot)),
m AS (SELECT shot, row // 2 AS br, col // 2 AS bc, coalesce(avg(v) FILTER (NOT inside), 0) AS mean FROM c GROUP BY ALL)
SELECT shot, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, round(round(CASE WHEN inside THEN v ELSE mean END / 0.02e0) * 0.02e0, 6) + 0.0 AS value
FROM c JOIN m USING (shot) WHERE row // 2 = br AND col // 2 = bc""")
def lossy_images(spark: SparkSession, d: str) -> DataFrame:
    """Regions of three by three pixels around the brightest one kept to 0.01, the rest in bins of two by two."""
    p = profile_shots(spark, d)
    top = F.array_position("p", F.array_max("p")) - 1
    peak = F.struct(F.lit(0).alias("seg"), F.floor(top / 8).cast("int").alias("row"), (top % 8).cast("int").alias("col"))
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8)))
    kept = images.lossy_round_trip(p.select("shot", F.array(rows).alias("image"), F.array(peak).alias("peaks")), abs_error=0.01, window=3, bin_size=2)
    cells = kept.select("shot", F.posexplode(F.get("image", F.lit(0))).alias("row", "r")).select("shot", "row", F.posexplode("r").alias("col", "value"))
    return cells.withColumn("value", F.round("value", 6) + 0.0)


# peaks of profiles


@query(f"""WITH {PROFILES}, c AS (SELECT shot, p, i, p[i] AS v FROM profiles, range(2, 64) AS t(i) WHERE p[i] > p[i - 1] AND p[i] > p[i + 1]),
o AS (SELECT shot, list(i ORDER BY v DESC, i DESC) AS ranked FROM c GROUP BY shot),
k AS (SELECT shot, unnest(list_reduce(list_transform(ranked, lambda x: [x]), lambda acc, e: CASE WHEN len(list_filter(acc, lambda a: abs(a - e[1]) < 5)) > 0 THEN acc ELSE list_concat(acc, e) END)) AS i FROM o),
s AS (SELECT shot, i, v, p, coalesce(list_max(list_filter(range(1, i), lambda j: p[j] > v)), 0) AS before, coalesce(list_min(list_filter(range(i + 1, 65), lambda j: p[j] > v)), 65) AS after FROM c JOIN k USING (shot, i)),
h AS (SELECT *, v - greatest(list_min(p[before + 1 : i]), list_min(p[i : after - 1])) AS rise FROM s)
SELECT shot, CAST(i - 1 AS INTEGER) AS place, round(v, 6) + 0.0 AS value, round(rise, 6) + 0.0 AS prominence FROM h WHERE rise >= 0.1""")
def prominent_profile_peaks(spark: SparkSession, d: str) -> DataFrame:
    found = peaks.profile_peaks(profile_shots(spark, d), ["shot"], "p", prominence=0.1, distance=5)
    return found.select("shot", "place", *((F.round(c, 6) + 0.0).alias(c) for c in ("value", "prominence")))


# geometry files and lineage


def geometry_panels(spark: SparkSession, d: str) -> DataFrame:
    # dealt out before a row becomes ten lines, as one row group can hold all rows
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice").hint("rebalance", "p_partkey")
    long = lambda c: F.lit(c).cast("long")
    turn = (F.col("p_partkey") % 4) * 0.25
    return p.select(
        F.col("p_size").alias("file"), F.concat(F.lit("p"), "p_partkey").alias("panel"), long(0).alias("min_fs"), (F.col("p_partkey") % 3).alias("max_fs"), long(0).alias("min_ss"), (F.col("p_partkey") % 2).alias("max_ss"),
        (F.col("p_retailprice") / 10).alias("corner_x"), (-F.col("p_retailprice") / 4).alias("corner_y"), F.lit(13333.0).alias("res"), (F.col("p_size") / 100).alias("coffset"),
        F.struct((1 - turn).alias("x"), turn.alias("y")).alias("fs"), F.struct((-turn).alias("x"), (1 - turn).alias("y")).alias("ss"))


@query("""WITH p AS (SELECT p_size AS file, 'p' || p_partkey AS panel, p_partkey % 3 AS f1, p_partkey % 2 AS s1, p_retailprice / 10 AS cx, -p_retailprice / 4 AS cy, (p_partkey % 4) * 0.25 AS t, p_size / 100 AS coffset FROM part),
c AS (SELECT *, a AS fs, b AS ss FROM p, range(3) AS x(a), range(2) AS y(b) WHERE a <= f1 AND b <= s1)
SELECT file, panel, fs, ss, round(cx + fs * (1 - t) - ss * t, 4) AS x, round(cy + fs * t + ss * (1 - t), 4) AS y FROM c""")
def geometry_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Panels written as lines of a geometry file, read back and laid out as pixels."""
    lines = geomfile.geometry_lines(geometry_panels(spark, d), keep=("file",))
    places = geomfile.pixel_places(geomfile.panels(lines, keep=("file",)), keep=("file",))
    return places.select("file", "panel", "fs", "ss", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("""WITH l AS (SELECT p_partkey AS id, p_size % 4 AS k, p_brand AS b FROM part)
SELECT id, CASE WHEN k = 1 THEN 'p1' END AS panel, CASE k WHEN 0 THEN 'clen' WHEN 1 THEN 'fs' ELSE 'mask' END AS key, CASE k WHEN 0 THEN '0.58' WHEN 1 THEN '+1.0x -0.5y' ELSE '/' || b END AS value FROM l WHERE k < 3""")
def geometry_entries(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size") % 4
    line = F.when(k == 0, "clen =  0.58 ; metres").when(k == 1, " p1/fs = +1.0x -0.5y").when(k == 2, F.concat(F.lit("mask = /"), "p_brand")).otherwise("; res = 5")
    return geomfile.entries(table(spark, d, "part").select(F.col("p_partkey").alias("id"), line.alias("line")), keep=("id",))


@query(f"""WITH {LEDGER}, r AS (SELECT e.id, e.valid_flag, e.tag, gen.run FROM entries AS e JOIN gen ON e.gen_cfg_id = gen.id),
m AS (SELECT run, arg_max(tag, id) AS sym, max(id) AS id FROM r WHERE valid_flag = 1 AND id % 3 <> 0 GROUP BY run), i AS (SELECT run, max(id) AS id FROM r WHERE id % 3 = 0 GROUP BY run)
SELECT run, 'in_files' AS parameter, '/w/' || id || '.hkl1 /w/' || id || '.hkl2' AS value, 'merge' AS source FROM m UNION ALL SELECT run, 'symmetry', sym, 'merge' FROM m
UNION ALL SELECT run, 'shell_file', '/w/' || id || '_Rsplit_n10.dat', 'merge' FROM m UNION ALL SELECT run, 'cell_file', id || '.cell', 'index' FROM i""")
def ledger_lineage(spark: SparkSession, d: str) -> DataFrame:
    """What each run's comparison of merged data would take from the ledger for its empty parameters."""
    e = entries(spark, d)
    merge = e.where("id % 3 <> 0").select("id", "gen_cfg_id", "valid_flag", F.concat(F.lit("/w/"), "id", F.lit(".hkl")).alias("out_file"), F.col("tag").alias("symmetry"))
    index = e.where("id % 3 = 0").select("id", "gen_cfg_id", "valid_flag", F.concat("id", F.lit(".cell")).alias("cell_file"))
    return lineage.filled_by_run({"merge": merge, "index": index}, gen_cfg(spark, d), "compare", {"fom": "Rsplit", "nshells": 10})
