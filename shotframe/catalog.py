"""Registered queries over the test tables, one or more for each operator, and the SQL they are held against.

The tables stand in for experiment data: events are shots, embeddings q profiles, lineitem absorption shots and
pixels, orders, customer and nation a run ledger. Floating results are rounded alike on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N
from shotframe.operators import binning, differences, filters, fits, geometry, images, ledger, peaks, profiles, textscan
from shotframe.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


# adapters, in both languages

SHOTS = """shots AS (SELECT event_id AS shot, ts, user_id, value AS ipm, event_type <> 'error' AS xray,
  event_type IN ('purchase', 'signup') AS laser, CAST(json_extract_string(props, '$.k') AS INTEGER) AS scan FROM events)"""
PROFILES = """profiles AS (SELECT vec_id AS shot, label AS scan, CAST(embedding AS DOUBLE[]) AS p, vec_id % 5 <> 0 AS xray, vec_id % 2 = 0 AS laser FROM embeddings),
 cells AS (SELECT shot, scan, xray, laser, i - 1 AS q_idx, p[i] AS v FROM profiles, range(1, 65) AS t(i))"""
XAS = """xas AS (SELECT l_linenumber AS scan, l_discount AS set_pt, l_discount + (l_tax - 0.04) / 10 AS energy, l_extendedprice AS raw,
  l_quantity AS ipm, l_returnflag <> 'R' AS xray, l_linestatus = 'O' AS laser FROM lineitem)"""
PIXELS = "pixels AS (SELECT l_partkey % 64 AS ix, l_suppkey % 64 AS iy, l_extendedprice AS v, l_returnflag, l_linestatus, l_orderkey AS shot FROM lineitem)"
IMAGE = PIXELS + ", image AS (SELECT CAST(iy - (SELECT min(iy) FROM pixels) AS BIGINT) AS row, CAST(ix - (SELECT min(ix) FROM pixels) AS BIGINT) AS col, sum(v) AS value FROM pixels GROUP BY 1, 2)"
LEDGER = """entries AS (SELECT o_orderkey AS id, o_custkey AS gen_cfg_id, o_custkey % 25 AS exec_cfg_id, o_orderpriority AS tag, o_totalprice AS out_value,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status, CAST(o_orderstatus = 'F' AS INTEGER) AS valid_flag FROM orders),
 gen AS (SELECT c_custkey AS id, c_mktsegment AS experiment, c_custkey % 50 AS run FROM customer),
 exe AS (SELECT n_nationkey AS id, n_name AS env FROM nation)"""


def shots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("shot"), "ts", "user_id", F.col("value").alias("ipm"), (F.col("event_type") != "error").alias("xray"), F.col("event_type").isin("purchase", "signup").alias("laser"), F.get_json_object("props", "$.k").cast("int").alias("scan"))


def profile_shots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("shot"), F.col("label").alias("scan"), F.col("embedding").cast("array<double>").alias("p"), (F.col("vec_id") % 5 != 0).alias("xray"), (F.col("vec_id") % 2 == 0).alias("laser"))


def xas_shots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_linenumber").alias("scan"), F.col("l_discount").alias("set_pt"), (F.col("l_discount") + (F.col("l_tax") - 0.04) / 10).alias("energy"), F.col("l_extendedprice").alias("raw"), F.col("l_quantity").alias("ipm"), (F.col("l_returnflag") != "R").alias("xray"), (F.col("l_linestatus") == "O").alias("laser"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select((F.col("l_partkey") % 64).alias("ix"), (F.col("l_suppkey") % 64).alias("iy"), F.col("l_extendedprice").alias("v"), "l_returnflag", "l_linestatus", F.col("l_orderkey").alias("shot"))


def image(spark: SparkSession, d: str) -> DataFrame:
    return images.assemble(pixels(spark, d))


def entries(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("gen_cfg_id"), (F.col("o_custkey") % 25).alias("exec_cfg_id"), F.col("o_orderpriority").alias("tag"), F.col("o_totalprice").alias("out_value"), status.alias("status"))
    return t.withColumn("valid_flag", ledger.valid_flag(F.col("status")))


def gen_cfg(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("experiment"), (F.col("c_custkey") % 50).alias("run"))


def exec_cfg(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("env"))


def on() -> Column:
    return F.col("xray") & F.col("laser")


def off() -> Column:
    return F.col("xray") & ~F.col("laser")


DIFF = "round({f}(v) FILTER (WHERE xray AND laser), 6) AS \"on\", round({f}(v) FILTER (WHERE xray AND NOT laser), 6) AS off, round({f}(v) FILTER (WHERE xray AND laser) - {f}(v) FILTER (WHERE xray AND NOT laser), 6) + 0.0 AS diff, count(*) FILTER (WHERE xray AND laser) AS n_on, count(*) FILTER (WHERE xray AND NOT laser) AS n_off"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# scan differences, absorption and emission


@query(f"WITH {XAS}, v AS (SELECT *, raw / ipm AS v FROM xas) SELECT CAST(scan AS INTEGER) AS scan, {DIFF.format(f='avg')} FROM v GROUP BY scan")
def xas_scan_diff_distinct(spark: SparkSession, d: str) -> DataFrame:
    out = differences.on_off_means(xas_shots(spark, d), ["scan"], N.divide(F.col("raw"), F.col("ipm")), on(), off(), skip_nan=False)
    return rounded(out, "on", "off", "diff")


EDGES51 = "b AS (SELECT min(x) AS lo, max(x) AS hi FROM s), e AS (SELECT i AS bin, lo + i * ((hi - lo) / {n}) AS lo, CASE WHEN i = {n} - 1 THEN hi ELSE lo + (i + 1) * ((hi - lo) / {n}) END AS hi FROM b, range({n}) AS t(i))"


@query(f"""WITH {SHOTS}, s AS (SELECT ipm AS x, ipm / (1 + scan) AS v, xray, laser FROM shots), {EDGES51.format(n=51)}
SELECT CAST(e.bin AS INTEGER) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, round((lo + hi) / 2, 6) AS center, {DIFF.format(f='avg')}
FROM e LEFT JOIN s ON s.x >= e.lo AND s.x < e.hi GROUP BY ALL""")
def xas_scan_diff_lxt_fast(spark: SparkSession, d: str) -> DataFrame:
    s = shots(spark, d)
    edges = binning.equal_width_edges(s, "ipm", 51)
    out = differences.by_edges(s, F.col("ipm"), edges, N.divide(F.col("ipm"), 1.0 + F.col("scan")), on(), off())
    return rounded(out, "lo", "hi", "center", "on", "off", "diff").withColumns({c: F.col(c).cast("long") for c in ("n_on", "n_off")})


MIDPOINTS = "c AS (SELECT DISTINCT set_pt AS c FROM xas), k AS (SELECT c, lag(c) OVER (ORDER BY c) AS p, lead(c) OVER (ORDER BY c) AS n, row_number() OVER (ORDER BY c) - 1 AS bin FROM c), e AS (SELECT bin, coalesce((p + c) / 2, c) AS lo, coalesce((c + n) / 2, c) AS hi FROM k)"


@query(f"WITH {XAS}, {MIDPOINTS} SELECT CAST(bin AS INTEGER) AS bin, round(lo, 9) AS lo, round(hi, 9) AS hi, round((lo + hi) / 2, 9) AS center FROM e")
def ccm_bins_midpoint(spark: SparkSession, d: str) -> DataFrame:
    return rounded(binning.bin_table(spark, binning.midpoint_edges(xas_shots(spark, d), "set_pt")), "lo", "hi", "center", digits=9)


@query(f"""WITH {XAS}, {MIDPOINTS}, m AS (SELECT max(bin) AS last FROM e), v AS (SELECT *, raw / ipm AS v FROM xas)
SELECT CAST(bin AS INTEGER) AS bin, round(lo, 9) AS lo, round(hi, 9) AS hi, round((lo + hi) / 2, 9) AS center,
 round(coalesce(avg(v) FILTER (WHERE xray AND laser), 0), 6) AS "on", round(coalesce(avg(v) FILTER (WHERE xray AND NOT laser), 0), 6) AS off,
 round(coalesce(avg(v) FILTER (WHERE xray AND laser) - avg(v) FILTER (WHERE xray AND NOT laser), 0), 6) + 0.0 AS diff,
 count(*) FILTER (WHERE xray AND laser) AS n_on, count(*) FILTER (WHERE xray AND NOT laser) AS n_off
FROM e CROSS JOIN m LEFT JOIN v ON energy >= lo AND (energy < hi OR (bin = last AND energy <= hi)) GROUP BY bin, lo, hi""")
def xas_ccm_diff(spark: SparkSession, d: str) -> DataFrame:
    x = xas_shots(spark, d)
    out = differences.absorption_by_energy(x, "energy", binning.ccm_edges(x, "energy", "set_pt"), N.divide(F.col("raw"), F.col("ipm")), on(), off())
    return rounded(rounded(out, "lo", "hi", "center", digits=9), "on", "off", "diff")


@query(f"""WITH {XAS}, s AS (SELECT DISTINCT energy AS x FROM xas), k AS (SELECT least(50, count(*)) AS n FROM s),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM s) SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / n), 9) AS lo, round(CASE WHEN i = n - 1 THEN hi ELSE lo + (i + 1) * ((hi - lo) / n) END, 9) AS hi
FROM b, k, range(50) AS t(i) WHERE i < n""")
def ccm_bins_unique(spark: SparkSession, d: str) -> DataFrame:
    return rounded(binning.bin_table(spark, binning.unique_edges(xas_shots(spark, d), "energy")).drop("center"), "lo", "hi", digits=9)


@query(f"WITH {SHOTS}, s AS (SELECT ipm AS x FROM shots), {EDGES51.format(n=51)} SELECT CAST(bin AS INTEGER) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, round((lo + hi) / 2, 6) AS center FROM e")
def scan_bins_equal_width(spark: SparkSession, d: str) -> DataFrame:
    return rounded(binning.bin_table(spark, binning.equal_width_edges(shots(spark, d), "ipm", 51)), "lo", "hi", "center")


@query(f"WITH {SHOTS} SELECT CAST(row_number() OVER (ORDER BY scan) - 1 AS INTEGER) AS bin, CAST(scan AS DOUBLE) AS value FROM (SELECT DISTINCT scan FROM shots)")
def scan_bins_distinct(spark: SparkSession, d: str) -> DataFrame:
    return binning.distinct_values(shots(spark, d), "scan")


@query(f"""WITH {XAS}, n AS (SELECT *, raw - 30000 AS norm, bool_or(raw - 30000 < 0) OVER () AS neg FROM xas)
SELECT CAST(scan AS INTEGER) AS scan, count(*) AS n, round(avg(raw / CASE WHEN neg THEN ipm ELSE norm END), 6) AS mean FROM n GROUP BY scan""")
def xas_norm_negative_fallback(spark: SparkSession, d: str) -> DataFrame:
    x = xas_shots(spark, d)
    by = differences.normaliser(x, F.col("raw") - 30000, F.col("ipm"))
    return x.groupBy("scan").agg(F.count("*").alias("n"), F.round(F.avg(N.divide(F.col("raw"), by)), 6).alias("mean"))


# filters


@query(f"WITH {SHOTS} SELECT shot, round(ipm, 6) AS ipm FROM shots WHERE xray AND laser AND ipm > 50")
def filter_named_and(spark: SparkSession, d: str) -> DataFrame:
    s = shots(spark, d)
    keep = filters.combine(filters.standard_filters(s, min_ipm=50.0), "xray on, laser on, total scattering, percentage, ipm")
    return s.where(keep).select("shot", F.round("ipm", 6).alias("ipm"))


@query(f"""WITH {SHOTS}, c AS (SELECT count(*) AS n, count(*) FILTER (xray) AS a, count(*) FILTER (NOT xray) AS b, count(*) FILTER (laser) AS c, count(*) FILTER (NOT laser) AS d, count(*) FILTER (ipm > 50) AS e FROM shots)
SELECT * FROM (SELECT 'xray on' AS filter, a AS n_pass, n AS n_total FROM c UNION ALL SELECT 'xray off', b, n FROM c UNION ALL SELECT 'laser on', c, n FROM c UNION ALL SELECT 'laser off', d, n FROM c UNION ALL SELECT 'ipm', e, n FROM c)""")
def filter_counts(spark: SparkSession, d: str) -> DataFrame:
    s = shots(spark, d)
    return filters.filter_counts(s, filters.standard_filters(s, min_ipm=50.0))


@query("""WITH n AS (SELECT count(*) AS n FROM events), r AS (SELECT i AS rank, n // 7 + CAST(i < n % 7 AS BIGINT) AS size FROM n, range(7) AS t(i))
SELECT CAST(rank AS INTEGER) AS rank, CAST(sum(size) OVER (ORDER BY rank) - size AS BIGINT) AS start, CAST(sum(size) OVER (ORDER BY rank) AS BIGINT) AS stop FROM r""")
def range_partition_bounds(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(filters.shot_ranges(table(spark, d, "events").count(), 7), "rank int, start long, stop long")


@query("SELECT event_id AS shot FROM events WHERE list_contains([CAST(user_id % 7 AS INTEGER), CAST(event_id % 5 AS INTEGER)], 3)")
def event_codes_contains(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").withColumn("event_codes", F.array((F.col("user_id") % 7).cast("int"), (F.col("event_id") % 5).cast("int")))
    return filters.with_event_code(s, 3).select(F.col("event_id").alias("shot"))


# profiles

AXIS = [float(i) for i in range(64)]


@query(f"WITH {PROFILES} SELECT shot, round(sum(v), 5) + 0.0 AS integrated FROM cells GROUP BY shot")
def integrated_intensity(spark: SparkSession, d: str) -> DataFrame:
    return profile_shots(spark, d).select("shot", F.round(N.array_total(F.col("p")), 5).alias("integrated"))


@query(f"WITH {PROFILES}, m AS (SELECT shot, q_idx % 32 AS q, sum(v) AS v FROM cells GROUP BY ALL) SELECT shot, CAST(q AS INTEGER) AS q, round(v, 5) + 0.0 AS v FROM m")
def xss_profile_nansum(spark: SparkSession, d: str) -> DataFrame:
    two = profile_shots(spark, d).select("shot", N.row_totals(F.array(F.slice("p", 1, 32), F.slice("p", 33, 32))).alias("p"))
    return rounded(profiles.exploded(two, "p", "q", "v"), "v", digits=5)


@query(f"WITH {PROFILES} SELECT shot, round(avg(v), 6) + 0.0 AS norm FROM cells WHERE q_idx > 9 AND q_idx < 35 GROUP BY shot")
def xss_qrange_norm(spark: SparkSession, d: str) -> DataFrame:
    return profile_shots(spark, d).select("shot", F.round(profiles.range_mean(F.col("p"), AXIS, 9, 35), 6).alias("norm"))


@query(f"WITH {PROFILES} SELECT shot, round(max(v), 6) + 0.0 AS top FROM cells GROUP BY shot")
def norm_by_max(spark: SparkSession, d: str) -> DataFrame:
    return profile_shots(spark, d).select("shot", F.round(N.array_largest(F.col("p")), 6).alias("top"))


@query(f"WITH {PROFILES} SELECT CAST(q_idx AS INTEGER) AS q_idx, round(avg(v), 6) + 0.0 AS dark FROM cells WHERE NOT xray GROUP BY q_idx")
def xss_dark_mean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profiles.dark_mean(profile_shots(spark, d), "p", ~F.col("xray")), "dark")


ONE_SIDED = {"on": "xray AND laser AND scan NOT IN (2, 3)", "off": "xray AND NOT laser AND scan NOT IN (1, 3)"}


def patterns(spark: SparkSession, d: str) -> DataFrame:
    """Shots with a (phi, q) pattern of two rows; scans 1 and 2 have shots of one side only, 3 of none."""
    row = lambda f: F.transform("p", f)
    return profile_shots(spark, d).select("shot", "scan", "xray", (on() & ~F.col("scan").isin(2, 3)).alias("on_"), (off() & ~F.col("scan").isin(1, 3)).alias("off_"), F.array(row(lambda x: F.abs(x) + 1), row(lambda x: x * x + 1)).alias("azav"))


def sided(a: str, b: str, digits: int) -> str:
    return f"""round({a}, {digits}) + 0.0 AS "on", round({b}, {digits}) + 0.0 AS off, round(coalesce({a}, 0) - coalesce({b}, 0), {digits}) + 0.0 AS diff, count(*) FILTER (WHERE {ONE_SIDED['on']}) AS n_on, count(*) FILTER (WHERE {ONE_SIDED['off']}) AS n_off"""


SIDED = sided(f"avg(v) FILTER (WHERE {ONE_SIDED['on']})", f"avg(v) FILTER (WHERE {ONE_SIDED['off']})", 6)


@query(f"""WITH {PROFILES}, a AS (SELECT shot, scan, xray, laser, q_idx, abs(v) + 1 AS x, v * v + 1 AS y FROM cells),
k AS (SELECT q_idx, avg(x + y) AS dark FROM a WHERE NOT xray GROUP BY q_idx),
n AS (SELECT shot, (avg(x) FILTER (q_idx > 9 AND q_idx < 35) + avg(y) FILTER (q_idx > 9 AND q_idx < 35)) / 2 AS norm FROM a GROUP BY shot),
z AS (SELECT scan, xray, laser, q_idx, (x + y - dark) / norm AS v FROM a JOIN k USING (q_idx) JOIN n USING (shot))
SELECT CAST(scan AS DOUBLE) AS scan, CAST(q_idx AS INTEGER) AS q_idx, {SIDED} FROM z GROUP BY ALL""")
def xss_scan_diff(spark: SparkSession, d: str) -> DataFrame:
    out = profiles.scattering_difference(patterns(spark, d), "azav", AXIS, "scan", F.col("on_"), F.col("off_"), ~F.col("xray"), 9, 35)
    return rounded(out, "on", "off", "diff")


@query(f"""WITH {PROFILES}, w AS (SELECT shot, scan, xray, laser, (avg(abs(v) + 1) FILTER (q_idx > 9 AND q_idx < 35) + avg(v * v + 1) FILTER (q_idx > 9 AND q_idx < 35)) / 2 AS norm,
 sum(abs(v) + 1) FILTER (q_idx < 4) AS raw FROM cells GROUP BY ALL), z AS (SELECT scan, xray, laser, raw / norm AS v FROM w)
SELECT CAST(scan AS INTEGER) AS bin, scan - 0.5e0 AS lo, scan + 0.5e0 AS hi, CAST(scan AS DOUBLE) AS center,
 round(coalesce(avg(v) FILTER (WHERE {ONE_SIDED['on']}), 0), 6) AS "on", round(coalesce(avg(v) FILTER (WHERE {ONE_SIDED['off']}), 0), 6) AS off,
 round(coalesce(avg(v) FILTER (WHERE {ONE_SIDED['on']}) - avg(v) FILTER (WHERE {ONE_SIDED['off']}), 0), 6) + 0.0 AS diff,
 count(*) FILTER (WHERE {ONE_SIDED['on']}) AS n_on, count(*) FILTER (WHERE {ONE_SIDED['off']}) AS n_off FROM z GROUP BY ALL""")
def xas_water_norm(spark: SparkSession, d: str) -> DataFrame:
    """Absorption over the water ring's norm; a side without shots is 0, and so is the difference."""
    s = patterns(spark, d).withColumn("water", profiles.pattern_norm(F.col("azav"), AXIS, 9, 35)).withColumn("raw", N.array_total(F.slice(F.get("azav", F.lit(0)), 1, 4)))
    norm = differences.normaliser(s, F.col("water"), F.lit(1.0))
    out = differences.absorption_by_energy(s, "scan", [i - 0.5 for i in range(11)], N.divide(F.col("raw"), norm), F.col("on_"), F.col("off_"))
    return rounded(out, "on", "off", "diff").withColumns({c: F.col(c).cast("long") for c in ("n_on", "n_off")})


@query(f"""WITH {PROFILES}, z AS (SELECT scan, xray, laser, q_idx, v FROM cells)
SELECT CAST(scan AS DOUBLE) AS scan, CAST(q_idx AS INTEGER) AS q_idx, {SIDED} FROM z GROUP BY ALL""")
def xes_scan_diff_sides(spark: SparkSession, d: str) -> DataFrame:
    """Emission by scan: a side without shots counts as 0 in the difference."""
    p = profile_shots(spark, d).withColumn("scan", F.col("scan").cast("double"))
    rows = profiles.exploded(p.select("scan", (on() & ~F.col("scan").isin(2, 3)).alias("on_"), (off() & ~F.col("scan").isin(1, 3)).alias("off_"), "p"), "p")
    out = differences.by_scan(p, rows, F.col("v"), F.col("on_"), F.col("off_"), spark.range(64).select(F.col("id").cast("int").alias("q_idx")), skip_nan=False)
    return rounded(out, "on", "off", "diff")


@query(f"WITH {PROFILES} SELECT CAST(q_idx AS INTEGER) AS q_idx, round(sum(v) FILTER (xray AND laser) / count(*), 6) + 0.0 AS value FROM cells GROUP BY q_idx")
def xss_laser_on_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = profiles.exploded(profile_shots(spark, d).select("xray", "laser", "p"), "p")
    return rounded(differences.global_profile(rows, "q_idx", F.col("v"), on()), "value")


@query(f"WITH {PROFILES} SELECT CAST(q_idx AS INTEGER) AS q_idx, {DIFF.format(f='avg').replace(', 6) AS', ', 6) + 0.0 AS')} FROM cells GROUP BY q_idx")
def xes_avg_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = profiles.exploded(profile_shots(spark, d).select("xray", "laser", "p"), "p")
    return rounded(differences.on_off_means(rows, ["q_idx"], F.col("v"), on(), off()), "on", "off", "diff")


@query(f"WITH {PROFILES} SELECT scan, CAST(q_idx AS INTEGER) AS q_idx, {DIFF.format(f='avg').replace(', 6) AS', ', 6) + 0.0 AS')} FROM cells GROUP BY scan, q_idx")
def xes_scan_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = profiles.exploded(profile_shots(spark, d).select("scan", "xray", "laser", "p"), "p")
    return rounded(differences.on_off_means(rows, ["scan", "q_idx"], F.col("v"), on(), off(), skip_nan=False), "on", "off", "diff")


@query(f"""WITH {PROFILES}, m AS (SELECT shot, q_idx // 8 AS row, q_idx % 8 AS col, v FROM cells), g AS (SELECT arg_max(col, s) AS g FROM (SELECT col, sum(v) AS s FROM m GROUP BY col))
SELECT shot, CAST(row AS INTEGER) AS row, round(sum(v), 5) + 0.0 AS value FROM m, g WHERE col >= greatest(0, g - 2) AND col < g + 2 GROUP BY shot, row""")
def xes_roi_window(spark: SparkSession, d: str) -> DataFrame:
    rows = profiles.exploded(profile_shots(spark, d).select("shot", "p"), "p", "i", "value")
    cells = rows.select("shot", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).cast("int").alias("col"), "value")
    return rounded(images.window_spectrum(cells, half=2), "value", digits=5)


# images


@query(f"WITH {IMAGE} SELECT row, col, round(value, 2) AS value FROM image")
def coo_assemble(spark: SparkSession, d: str) -> DataFrame:
    return rounded(image(spark, d), "value", digits=2)


# means of money values lie exactly between two roundings now and then, where the order of a sum decides; parts of pi do not
RINGS = "{x}, g AS (SELECT CAST(floor({r}) AS INTEGER) AS r, sum(value) AS s, count(*) AS n FROM image GROUP BY 1), a AS (SELECT CAST(i AS INTEGER) AS r FROM (SELECT max(r) AS m FROM g), range(100) AS t(i) WHERE i <= m) SELECT a.r, round(CASE WHEN coalesce(s / n, 0) < 10 THEN 0 ELSE s / n END / pi(), 4) AS value FROM a LEFT JOIN g USING (r)"
RADIUS = "sqrt(pow(col - 31.5, 2) + pow(row - 30.25, 2))"


@query("WITH " + RINGS.format(x=IMAGE, r=RADIUS))
def radial_profile(spark: SparkSession, d: str) -> DataFrame:
    return images.radial_profile(image(spark, d), 31.5, 30.25).withColumn("value", F.round(F.col("value") / F.pi(), 4))


@query("WITH " + RINGS.format(x=IMAGE, r=f"CASE WHEN (row + col) % 7 <> 0 THEN {RADIUS} ELSE 0 END"))
def radial_profile_masked(spark: SparkSession, d: str) -> DataFrame:
    mask = ((F.col("row") + F.col("col")) % 7 != 0).cast("int")
    return images.radial_profile(image(spark, d), 31.5, 30.25, mask).withColumn("value", F.round(F.col("value") / F.pi(), 4))


@query(f"WITH {IMAGE} SELECT row, col, round((value - (SELECT avg(value) FROM image)) / (SELECT stddev_pop(value) FROM image), 6) + 0.0 AS value FROM image")
def image_normalise(spark: SparkSession, d: str) -> DataFrame:
    return rounded(images.normalise(image(spark, d)), "value")


@query(f"WITH {IMAGE} SELECT row, col, round(CASE WHEN value > 400000 THEN 0 ELSE value END, 2) AS value FROM image")
def image_clip(spark: SparkSession, d: str) -> DataFrame:
    return rounded(images.clip_hot(image(spark, d), 400000.0), "value", digits=2)


@query(f"WITH {IMAGE} SELECT round(quantile_cont(value, 0.01), 3) AS low, round(quantile_cont(value, 0.99), 3) AS high FROM image")
def percentile_1_99(spark: SparkSession, d: str) -> DataFrame:
    return rounded(images.percentile_range(image(spark, d)), "low", "high", digits=3)


@query(f"WITH {IMAGE} SELECT row, round(sum(CASE WHEN value > 200000 THEN value ELSE 0 END), 2) AS value FROM image WHERE row >= 8 AND row < 40 AND col >= 4 AND col < 60 GROUP BY row")
def roi_projection(spark: SparkSession, d: str) -> DataFrame:
    return rounded(images.projection(images.region(image(spark, d), (8, 40), (4, 60), 200000.0), "row"), "value", digits=2)


@query(f"""WITH {IMAGE}, a AS (SELECT CAST(floor({RADIUS} * 10 / 40.0) AS INTEGER) AS r_bin, CAST(least(7, floor((atan2(row - 30.25, col - 31.5) + pi()) / (2 * pi()) * 8)) AS INTEGER) AS phi_bin, value FROM image)
SELECT phi_bin, r_bin, round(avg(value) / pi(), 4) AS value FROM a WHERE r_bin < 10 GROUP BY ALL""")
def azimuthal_average(spark: SparkSession, d: str) -> DataFrame:
    return images.azimuthal(image(spark, d), 31.5, 30.25, 10, 40.0, 8).withColumn("value", F.round(F.col("value") / F.pi(), 4))


@query("SELECT event_id AS shot, CAST(greatest(0, floor(value / 9.5) + CASE WHEN value / 9.5 - floor(value / 9.5) >= 0.8 THEN 1 ELSE 0 END) AS INTEGER) AS photons FROM events")
def photon_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("shot"), images.photons(F.col("value")).alias("photons"))


@query(f"WITH {PIXELS} SELECT CASE WHEN shot % 10 >= 2 THEN 'hit' ELSE 'miss' END AS kind, iy AS row, ix AS col, greatest(0, max(v)) AS value FROM pixels GROUP BY ALL")
def powder_max(spark: SparkSession, d: str) -> DataFrame:
    p = pixels(spark, d).select(F.col("iy").alias("row"), F.col("ix").alias("col"), F.col("v").alias("value"), "shot")
    return images.powder_max(p, F.col("shot") % 10, min_peaks=2)


@query(f"WITH {PIXELS} SELECT iy AS row, ix AS col, round(sum(v), 2) AS calib, round(coalesce(sum(v) FILTER (l_returnflag = 'R'), 0), 2) AS calib_dropped, round(coalesce(sum(v * v) FILTER (l_returnflag = 'R'), 0) / 1e6, 3) AS dropped_square FROM pixels GROUP BY ALL")
def run_sums(spark: SparkSession, d: str) -> DataFrame:
    p = pixels(spark, d).select(F.col("iy").alias("row"), F.col("ix").alias("col"), F.col("v").alias("value"), "l_returnflag")
    out = images.run_sums(p, F.col("l_returnflag") == "R")
    return out.select("row", "col", F.round("calib", 2).alias("calib"), F.round("calib_dropped", 2).alias("calib_dropped"), F.round(F.col("calib_dropped_square") / 1e6, 3).alias("dropped_square"))


# geometry and peaks


@query("SELECT CAST((x * 5 + y) * 2 + d AS INTEGER) AS candidate, CAST(494 + 3 * x AS DOUBLE) AS cx, CAST(504 + 3 * y AS DOUBLE) AS cy, CAST(90 + 10 * d AS DOUBLE) AS distance FROM range(5) AS a(x), range(5) AS b(y), range(2) AS c(d)")
def center_grid(spark: SparkSession, d: str) -> DataFrame:
    return geometry.center_grid(spark, (500.0, 510.0), [90.0, 100.0]).withColumn("candidate", F.col("candidate").cast("int"))


QPEAKS = "p AS (SELECT DISTINCT l_linenumber AS k, round(0.0171 * l_linenumber + 0.0002 * (l_linenumber % 3), 5) AS q FROM lineitem)"
RING_SCORES = QPEAKS + ", s AS (SELECT CAST(0.01 AS DOUBLE) + i * CAST(0.00005 AS DOUBLE) AS dq FROM range(400) AS t(i)), c AS (SELECT dq, avg(least(q - floor(q / dq) * dq, abs(dq - (q - floor(q / dq) * dq)))) / dq AS score FROM p, s WHERE q / dq < 13 GROUP BY dq)"


@query(f"WITH {RING_SCORES} SELECT round(dq, 7) AS dq, round(score, 6) AS score FROM c")
def ring_score(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(geometry.ring_scores(_q_peaks(spark, d)), "dq", digits=7), "score")


@query(f"WITH {RING_SCORES} SELECT round(arg_min(dq, score), 7) AS dq, round((avg(score) - min(score)) / stddev_pop(score), 5) AS final_score FROM c")
def ring_best_spacing(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(geometry.best_spacing(geometry.ring_scores(_q_peaks(spark, d))), "dq", digits=7), "final_score", digits=5)


def _q_peaks(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(n.alias("k"), F.round(0.0171 * n + 0.0002 * (n % 3), 5).alias("q")).distinct()


@query(f"WITH {PROFILES}, p AS (SELECT q_idx, avg(v) * 100 AS v FROM cells GROUP BY q_idx), w AS (SELECT *, lag(v) OVER (ORDER BY q_idx) AS a, lead(v) OVER (ORDER BY q_idx) AS b FROM p) SELECT CAST(q_idx AS INTEGER) AS q_idx, round(v, 4) AS v FROM w WHERE v > a AND v > b AND v >= 1")
def local_maxima(spark: SparkSession, d: str) -> DataFrame:
    return rounded(peaks.local_maxima(_mean_profile(spark, d), "q_idx", "v", 1.0), "v", digits=4)


@query(f"WITH {PROFILES}, p AS (SELECT q_idx, avg(v) * 100 AS v FROM cells GROUP BY q_idx), w AS (SELECT *, lag(v) OVER (ORDER BY q_idx) AS a, lead(v) OVER (ORDER BY q_idx) AS b FROM p), m AS (SELECT q_idx, v, row_number() OVER (ORDER BY q_idx) AS k FROM w WHERE v > a AND v > b AND v >= 0) SELECT CAST(q_idx AS INTEGER) AS q_idx, round(v, 4) AS v FROM m WHERE k <= 8 ORDER BY m.v DESC, m.q_idx LIMIT 4")
def topk_peaks(spark: SparkSession, d: str) -> DataFrame:
    return rounded(peaks.strongest(peaks.local_maxima(_mean_profile(spark, d), "q_idx", "v", 0.0), "q_idx", "v"), "v", digits=4)


def _mean_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = profiles.exploded(profile_shots(spark, d).select("p"), "p")
    return rows.groupBy("q_idx").agg((F.avg("v") * 100).alias("v"))


@query("""WITH p AS (SELECT l_orderkey AS shot, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT shot % 4 AS rank, count(*) AS n, count(*) FILTER (n BETWEEN 3 AND 5) AS h FROM p GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS events, CAST(sum(h) AS BIGINT) AS hits, printf('%.2f', sum(h) / sum(n)) AS rate, array_to_string(list(h ORDER BY rank), ',') AS hits_per_rank FROM r""")
def hit_filter_rate(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("shot")).count()
    out = peaks.hit_summary(s, F.col("count").between(3, 5), F.col("shot") % 4)
    return out.withColumn("hits_per_rank", F.array_join("hits_per_rank", ","))


@query("SELECT l_orderkey AS shot, l_linenumber AS peak, round(sqrt(pow(l_partkey % 64 + 0.5 - 31.5, 2) + pow(l_suppkey % 64 + 0.5 - 30.25, 2)), 6) AS radius FROM lineitem")
def peak_radius(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("shot"), F.col("l_linenumber").alias("peak"), F.lit(0).alias("seg"), (F.col("l_suppkey") % 64).alias("row"), (F.col("l_partkey") % 64).alias("col"))
    grid = spark.range(64 * 64).select(F.lit(0).alias("seg"), F.floor(F.col("id") / 64).alias("row"), (F.col("id") % 64).alias("col")).withColumns({"ix": F.col("col"), "iy": F.col("row")})
    return rounded(peaks.peak_radius(p, grid, 31.5, 30.25), "radius").select("shot", "peak", "radius")


@query("SELECT event_id AS shot, round(CASE WHEN event_type <> 'error' THEN value ELSE 12398.4197386209 / (1.0 + event_id % 3) END, 6) AS energy FROM events")
def photon_energy_fallback(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    measured = F.when(F.col("event_type") != "error", F.col("value")).otherwise(F.when(F.col("event_id") % 2 == 0, F.lit(N.INF)))
    return e.select(F.col("event_id").alias("shot"), F.round(N.photon_energy(measured, 1.0 + F.col("event_id") % 3), 6).alias("energy"))


@query("SELECT event_id AS shot, round(3.5 * exp(-pow(value - 50, 2) / (2 * 12.5 * 12.5)) + 0.25, 9) AS g FROM events")
def gaussian_eval(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("shot"), F.round(N.gaussian(F.col("value"), 3.5, 50.0, 12.5, 0.25), 9).alias("g"))


@query("SELECT event_id AS shot, round(value * sqrt(8 * ln(2)), 6) AS fwhm FROM events")
def sigma_to_fwhm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("shot"), F.round(N.sigma_to_fwhm(F.col("value")), 6).alias("fwhm"))


@query()
def fit_overlap_gaussian(spark: SparkSession, d: str) -> DataFrame:
    s = shots(spark, d)
    curve = s.groupBy((F.col("user_id") % 4).alias("curve"), "scan").agg(F.avg("ipm").alias("y")).withColumn("x", F.col("scan").cast("double"))
    return fits.gaussian_fits(curve, ["curve"], "x", "y")


@query(f"""WITH {SHOTS}, c AS (SELECT user_id % 4 AS curve, scan, avg(ipm) AS y FROM shots GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY curve ORDER BY scan) - 1 AS i, count(*) OVER (PARTITION BY curve) AS n FROM c),
t AS (SELECT a.curve, a.scan, sum(b.y) AS s FROM r AS a JOIN r AS b ON a.curve = b.curve AND b.i BETWEEN (a.n - 1) // 2 + a.i - a.n // 2 + 1 AND (a.n - 1) // 2 + a.i GROUP BY ALL),
m AS (SELECT curve, max(s) AS top FROM t GROUP BY curve)
SELECT t.curve, CAST(min(scan) AS DOUBLE) AS t0 FROM t JOIN m ON t.curve = m.curve AND s >= top - 1e-9 GROUP BY t.curve""")
def convolution_t0(spark: SparkSession, d: str) -> DataFrame:
    curve = shots(spark, d).groupBy((F.col("user_id") % 4).alias("curve"), "scan").agg(F.avg("ipm").alias("y")).withColumn("x", F.col("scan").cast("double"))
    return fits.step_times(curve, ["curve"], "x", "y")


@query()
def find_peaks_images(spark: SparkSession, d: str) -> DataFrame:
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8)))
    p = profile_shots(spark, d).select("shot", F.array(rows).alias("image"))
    found = peaks.find_peaks(p, npix_min=1, amax_thr=0.1, atot_thr=0.1, son_min=1.0, rank=2, r0=2.0, dr=1.5, nsigm=1.0)
    return found.select("shot", "n_peaks", F.round(F.aggregate("peaks", F.lit(0.0), lambda a, x: a + x["atot"]), 6).alias("total"))


@query()
def geometry_search(spark: SparkSession, d: str) -> DataFrame:
    grid = geometry.center_grid(spark, (31.5, 30.25), [100.0], (-2, 2, 3), (-2, 2, 3))
    return geometry.search(grid, image(spark, d), 1.0, 0.1, iterations=2)


@query(f"""WITH {IMAGE}, g AS (SELECT CAST(x * 3 + y AS INTEGER) AS candidate, 29.5 + 2 * x AS cx, 28.25 + 2 * y AS cy FROM range(3) AS a(x), range(3) AS b(y)),
k AS (SELECT candidate, CAST(floor(sqrt(pow(col - cx, 2) + pow(row - cy, 2))) AS INTEGER) AS r, avg(value) AS m FROM image, g GROUP BY ALL),
a AS (SELECT candidate, unnest(range(0, max(r) + 1)) AS r FROM k GROUP BY candidate)
SELECT a.candidate, CAST(a.r AS INTEGER) AS r, round(CASE WHEN coalesce(m, 0) < 10 THEN 0 ELSE m END / pi(), 3) AS value FROM a LEFT JOIN k ON a.candidate = k.candidate AND a.r = k.r""")
def candidate_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Radial profiles around every centre of a grid, in one aggregation over the pixels."""
    grid = geometry.center_grid(spark, (31.5, 30.25), [100.0], (-2, 2, 3), (-2, 2, 3))
    found = geometry.candidate_profiles(image(spark, d), grid)
    return found.select("candidate", F.posexplode("profile").alias("r", "value")).select("candidate", "r", F.round(F.col("value") / F.pi(), 3).alias("value"))


# ledger


@query(f"WITH {LEDGER} SELECT arg_max(out_value, id) AS out_value FROM entries WHERE valid_flag = 1")
def ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest_entry(entries(spark, d), "out_value")


@query(f"WITH {LEDGER} SELECT arg_max(out_value, id) AS out_value FROM entries WHERE valid_flag = 1 AND gen_cfg_id IN (SELECT id FROM gen WHERE run = 12)")
def ledger_latest_for_run(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest_entry(entries(spark, d), "out_value", True, gen_cfg(spark, d), 12)


@query(f"WITH {LEDGER} SELECT coalesce((SELECT arg_max(out_value, id) FROM entries WHERE valid_flag = 1 AND tag = 'none'), (SELECT arg_max(out_value, id) FROM entries WHERE valid_flag = 1 AND tag = '1-URGENT')) AS out_value")
def ledger_latest_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    e = entries(spark, d)
    return ledger.first_known([ledger.latest_entry(e.where(F.col("tag") == t), "out_value") for t in ("none", "1-URGENT")], "out_value")


@query(f"WITH {LEDGER} SELECT e.id, e.status, e.valid_flag, gen.experiment AS gen_experiment, gen.run AS gen_run, exe.env AS exec_env FROM entries AS e JOIN gen ON e.gen_cfg_id = gen.id JOIN exe ON e.exec_cfg_id = exe.id")
def ledger_history(spark: SparkSession, d: str) -> DataFrame:
    return ledger.linked(entries(spark, d), gen_cfg(spark, d), exec_cfg(spark, d)).select("id", "status", "valid_flag", "gen_experiment", "gen_run", "exec_env")


@query(f"WITH {LEDGER} SELECT gen_cfg_id, exec_cfg_id, status, max(id) AS id, count(*) AS n FROM entries GROUP BY ALL")
def ledger_dedup_id(spark: SparkSession, d: str) -> DataFrame:
    return ledger.shared_ids(entries(spark, d), ["gen_cfg_id", "exec_cfg_id", "status"])


@query('SELECT event_id AS id, CAST(user_id % 10 AS INTEGER) AS "a.b[0]", CAST(event_id % 10 AS INTEGER) AS "a.b[1]", event_type AS "a.c", value AS a2 FROM events')
def ledger_flatten(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.struct(F.array((F.col("user_id") % 10).cast("int"), (F.col("event_id") % 10).cast("int")).alias("b"), F.col("event_type").alias("c")).alias("a"), F.col("value").alias("a2"))
    flat = e.select("id", *ledger.flat_columns(e, "a"), "a2")
    return flat.select("id", *[F.get("`a.b`", F.lit(i)).alias(f"a.b[{i}]") for i in (0, 1)], "`a.c`", "a2")


@query("SELECT 'n_regionkey' AS name UNION ALL SELECT 'n_name' UNION ALL SELECT 'n_nationkey'")
def ledger_new_columns(spark: SparkSession, d: str) -> DataFrame:
    """What a row like those of nation would add to a ledger that has a row of region."""
    kept = ledger.Ledger(spark, shared_folder(spark))
    first = lambda t: table(spark, d, t).first().asDict()
    kept.append("places", first("region"))
    return spark.createDataFrame([(c,) for c in kept.new_columns("places", first("nation"))], "name string")


# text


@query("SELECT count(*) FILTER (contains(text, 'the')) AS n_indexed, count(*) AS n_chunks, printf('%.2f', CASE WHEN count(*) > 0 THEN count(*) FILTER (contains(text, 'the')) / count(*) ELSE 0 END) AS rate FROM documents")
def index_rate(spark: SparkSession, d: str) -> DataFrame:
    """Documents as the chunks of a stream file; those with a certain word are indexed."""
    chunk = F.array_compact(F.array(F.when(F.contains("text", F.lit("the")), F.lit("Cell parameters 7.9 7.9 3.8 nm, 90 90 90 deg")), F.lit("----- End chunk -----")))
    return textscan.indexing_rate(table(spark, d, "documents").select(F.explode(chunk).alias("line")))


LINES = r"lines AS (SELECT doc_id, unnest(generate_series(0, len(string_split(t, chr(10))) - 1)) AS line_no, unnest(string_split(t, chr(10))) AS line FROM (SELECT doc_id, regexp_replace(text, '\n$', '') AS t FROM documents WHERE text IS NOT NULL))"


@query(f"WITH {LINES} SELECT doc_id, count(*) AS n FROM lines WHERE contains(line, 'tion') GROUP BY doc_id")
def grep_count(spark: SparkSession, d: str) -> DataFrame:
    lines = textscan.numbered_lines(table(spark, d, "documents"), keys=("doc_id",))
    return textscan.grep(lines, "tion").groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"WITH {LINES} SELECT 'documents' AS source, CAST(line_no AS INTEGER) AS line_no, md5(line) AS line_md5 FROM lines UNION ALL SELECT 'benchmark', CAST(i - 1 AS INTEGER), md5(string_split(text, chr(10))[i]) FROM benchmark, range(1, 100) AS t(i) WHERE i <= len(string_split(text, chr(10)))")
def text_lines_concat(spark: SparkSession, d: str) -> DataFrame:
    a = textscan.numbered_lines(table(spark, d, "documents")).withColumn("source", F.lit("documents"))
    b = textscan.numbered_lines(table(spark, d, "benchmark")).withColumn("source", F.lit("benchmark"))
    return a.unionByName(b).select("source", "line_no", F.md5(F.col("line").cast("binary")).alias("line_md5"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, round(10 / l_quantity, 6) AS resolution, l_discount AS value FROM lineitem")
def shell_table_parse(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws("  ", F.lit(""), "l_quantity", "l_discount", "l_tax")
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), line.alias("line"))
    shells = textscan.shells(textscan.shell_table(rows, keep=("k", "n")), keep=("k", "n"))
    return shells.withColumn("resolution", F.round("resolution", 6))


@query("SELECT c_custkey AS id, c_mktsegment || '_Run' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS name FROM customer")
def run_name_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), textscan.run_name(F.col("c_mktsegment"), F.col("c_custkey") % 10000).alias("name"))


@query("SELECT o_orderkey AS id, concat_ws(';', 'status: ' || o_orderstatus, CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE 'priority: ' || o_orderpriority END) AS summary FROM orders")
def summary_string(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    empty = F.when(F.col("o_orderpriority").startswith("1"), "").otherwise(F.col("o_orderpriority"))
    return o.select(F.col("o_orderkey").alias("id"), textscan.summary_string({"status": F.col("o_orderstatus"), "priority": empty}).alias("summary"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'p0/coffset = 0.58' WHEN p_size % 3 = 0 THEN 'p0/res = 11.5' ELSE p_name END AS line FROM part")
def geom_line_rewrite(spark: SparkSession, d: str) -> DataFrame:
    line = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("p0/coffset = "), "p_size")).when(F.col("p_size") % 3 == 0, F.lit("p0/res = 5000.0")).otherwise(F.col("p_name"))
    return textscan.with_offset_and_resolution(table(spark, d, "part").select(F.col("p_partkey").alias("id"), line.alias("line")), 0.58, 11.5)


@query("""SELECT p_partkey AS id, CAST(k AS INTEGER) AS k, line FROM (
SELECT p_partkey, 0 AS k, CASE p_size % 3 WHEN 0 THEN 'clen = 1' WHEN 1 THEN 'data = /entry_1/data_1/data' ELSE '; other = 1' END AS line FROM part
UNION ALL SELECT p_partkey, 1, '' FROM part WHERE p_size % 3 = 1 UNION ALL SELECT p_partkey, 2, 'peak_list = /entry_1/result_1' FROM part WHERE p_size % 3 = 1 UNION ALL SELECT p_partkey, 3, 'peak_list_type = cxi' FROM part WHERE p_size % 3 = 1)""")
def geom_peak_lists(spark: SparkSession, d: str) -> DataFrame:
    line = F.when(F.col("p_size") % 3 == 0, "; clen = 1").when(F.col("p_size") % 3 == 1, "data = /entry_1/data_1/data").otherwise("; other = 1")
    out = textscan.with_peak_lists(table(spark, d, "part").select(F.col("p_partkey").alias("line_no"), line.alias("line")))
    return out.select(F.floor(F.col("line_no") / 4).alias("id"), (F.col("line_no") % 4).cast("int").alias("k"), "line")


@query("SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) WHEN event_id % 3 = 1 THEN '0.5' ELSE event_type END AS value FROM events")
def numeric_coercion(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.lpad(F.col("event_id").cast("string"), 12, "0")).when(F.col("event_id") % 3 == 1, "0.50").otherwise(F.col("event_type"))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), textscan.number_or_text(raw).alias("value"))


@query(f"WITH {SHOTS} SELECT user_id % 16 AS rank, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY user_id % 16) - count(*) AS BIGINT) AS start FROM shots GROUP BY 1")
def rank_prefix_sums(spark: SparkSession, d: str) -> DataFrame:
    n = shots(spark, d).groupBy((F.col("user_id") % 16).alias("rank")).agg(F.count("*").alias("n"))
    return n.withColumn("start", F.coalesce(F.sum("n").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


# streaming


@query("SELECT date_trunc('day', ts) AS start, count(*) AS events, count(*) FILTER (value > 50) AS hits FROM events GROUP BY 1")
def stream_hit_counts(spark: SparkSession, d: str) -> DataFrame:
    from shotframe.streaming import reductions

    live = reductions.live_shots(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)
    reductions.run_to_memory(reductions.stream_hit_counts(live, F.col("value") > 50, window="1 day"), "stream_hit_counts_out")
    return spark.table("stream_hit_counts_out").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"WITH {PIXELS} SELECT CASE WHEN shot % 10 >= 2 THEN 'hit' ELSE 'miss' END AS kind, iy AS row, ix AS col, greatest(0, max(v)) AS value FROM pixels GROUP BY ALL")
def stream_powder_max(spark: SparkSession, d: str) -> DataFrame:
    from shotframe.streaming import reductions

    raw = table(spark, d, "lineitem")
    live = reductions.live_shots(spark, f"{d}/lineitem.parquet*", raw.schema)
    p = live.select((F.col("l_suppkey") % 64).alias("row"), (F.col("l_partkey") % 64).alias("col"), F.col("l_extendedprice").alias("value"), F.col("l_orderkey").alias("shot"))
    reductions.run_to_memory(reductions.stream_powder_max(p, F.col("shot") % 10), "stream_powder_max_out")
    return spark.table("stream_powder_max_out")
