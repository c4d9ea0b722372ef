"""Registered queries of what surrounds the analyses: filters by name, instruments, masks, hits, ledger rows, text and small
sinks; with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.catalog import IMAGE, LEDGER, PIXELS, PROFILES, SHOTS, entries, image, pixels, profile_shots, query, shots, table
from shotframe.functions import nansafe as N
from shotframe.operators import binning, filters, fits, hits, images, kernels, ledger, masks, peaks, sinks, textscan
from shotframe.sources import instrument
from shotframe.sources.shots import DETECTORS, azimuthal_column, detector, numbers, scan_variable
from shotframe.streaming import reductions

# filters by name, over all four flags


@query(f"""WITH {SHOTS} SELECT shot, xray AND laser AND ipm * 2 > 40 AND ipm > 30 AS on_, xray AND NOT laser AND ipm * 2 > 40 AND ipm > 30 AS off_
FROM shots""")
def filter_on_and_off_sets(spark: SparkSession, d: str) -> DataFrame:
    s = shots(spark, d).withColumn("iscat", F.col("ipm") * 2)
    f = filters.standard_filters(s, 40.0, 30.0)
    return s.select("shot", filters.combine(f, filters.DEFAULT).alias("on_"), filters.combine(f, filters.LASER_OFF).alias("off_"))


@query(f"WITH {SHOTS} SELECT shot, ipm FROM shots WHERE shot % 7 = 3 ORDER BY shot LIMIT 25")
def first_events(spark: SparkSession, d: str) -> DataFrame:
    return shots(spark, d).where("shot % 7 = 3").select("shot", "ipm").orderBy("shot").limit(25)


@query("SELECT event_id AS shot, round(event_id * (count(*) OVER () / (count(*) OVER () - 1)), 6) AS scan FROM events")
def scan_of_shot_numbers(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "events").withColumnRenamed("event_id", "shot")
    scan, _ = scan_variable(s, ["lxt", "lens_v"])
    return s.select("shot", F.round(scan, 6).alias("scan"))


@query("SELECT event_id AS shot, 'lens_v' AS name, value AS scan, 'Rayonix' AS detector, event_id % 3 AS azav FROM events")
def columns_by_preference(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    s = e.select(F.col("event_id").alias("shot"), F.col("value").alias("scan/lens_v"), (F.col("event_id") % 3).alias("Rayonix/pyfai_azav"), F.lit(0).alias("Jungfrau4M/azav_azav"), F.lit(1.0).alias("enc/lasDelay"))
    scan, name = scan_variable(s, ["lxt", "lens_v"])
    det = detector(s, DETECTORS)
    return s.select("shot", F.lit(name).alias("name"), scan.alias("scan"), F.lit(det).alias("detector"), F.col(f"`{azimuthal_column(s, det)}`").alias("azav"))


@query("WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT i AS bin, round(lo + i * ((hi - lo) / 10), 6) AS lower, CASE WHEN i < 10 THEN round(lo + (i + 0.5) * ((hi - lo) / 10), 6) END AS center FROM b, range(11) AS t(i)")
def scan_bin_names(spark: SparkSession, d: str) -> DataFrame:
    edges = binning.equal_width_edges(table(spark, d, "events"), "value", 10)
    centers = [*binning.bin_names(edges), None]
    rows = [(i, a, c) for i, (a, c) in enumerate(zip(binning.bin_names(edges, lower=True), centers, strict=True))]  # eleven edges
    return spark.createDataFrame(rows, "bin long, lower double, center double").select("bin", F.round("lower", 6).alias("lower"), F.round("center", 6).alias("center"))


# instruments


NAMES = "CASE p_partkey % 12 WHEN 0 THEN 'XPP-SB2-BMMON' WHEN 1 THEN 'CXI-DG2-BMMON' WHEN 2 THEN 'XX-IPM-01' WHEN 3 THEN 'Ipm9' WHEN 4 THEN 'a-Ipm9' WHEN 5 THEN 'DIO3' WHEN 6 THEN 'b-Imb2' WHEN 7 THEN 'USB7' WHEN 8 THEN 'adc1' WHEN 9 THEN 'epix_1' WHEN 10 THEN 'evr0' ELSE p_name END"


@query(f"""WITH n AS (SELECT DISTINCT {NAMES} AS name FROM part) SELECT name, CASE WHEN contains(name, 'BMMON') THEN 'beam monitor'
WHEN contains(name, 'IPM') OR instr(name, 'Ipm') > 1 THEN 'intensity and position' WHEN contains(name, 'DIO') OR instr(name, 'Imb') > 1 THEN 'intensity'
WHEN contains(name, 'USB') THEN 'encoder' WHEN contains(name, 'adc') THEN 'adc' WHEN regexp_matches(name, 'cs|Cs|epix|Epix|jungfrau|Jungfrau') THEN 'image' ELSE 'area' END AS kind
FROM n WHERE name <> 'XPP-SB2-BMMON' AND name <> 'EBeam' AND NOT contains(name, 'evr')""")
def detectors_to_discover(spark: SparkSession, d: str) -> DataFrame:
    return instrument.to_discover(table(spark, d, "part").select(F.expr(NAMES).alias("name")), "xppx12345")


@query("SELECT p_size AS id, round(p_retailprice / 1e3, 6) AS pixel_size, round(p_retailprice * 10, 6) AS wavelength, count(*) AS n FROM part GROUP BY ALL")
def beam_numbers(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("pv", F.col("p_retailprice"))
    return p.groupBy(F.col("p_size").alias("id"), F.round(instrument.pixel_size_mm(F.col("pv")), 6).alias("pixel_size"), F.round(instrument.wavelength_angstrom(F.col("pv")), 6).alias("wavelength")).agg(F.count("*").alias("n"))


@query("SELECT round(-avg(p_retailprice) / 1e3, 6) AS distance, 85.5 :: DOUBLE AS guess FROM part")
def detector_distance(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    known = instrument.distance_mm(p, 85.5, "p_retailprice").withColumnRenamed("distance", "guess")
    return instrument.distance_mm(p, None, "p_retailprice").select(F.round("distance", 6).alias("distance")).crossJoin(known)  # one row each


@query("""WITH c AS (SELECT user_id % 4 AS pv, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL),
s AS (SELECT event_id AS shot, user_id % 5 AS pv, ts FROM events WHERE event_type <> 'purchase')
SELECT s.shot, s.pv, c.value FROM s ASOF LEFT JOIN c ON s.pv = c.pv AND s.ts >= c.ts""")
def slow_values_of_shots(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    c = e.where("event_type = 'purchase'").select((F.col("user_id") % 4).alias("pv"), "ts", "value")
    s = e.where("event_type <> 'purchase'").select(F.col("event_id").alias("shot"), (F.col("user_id") % 5).alias("pv"), "ts")
    return instrument.slow_values(s, c).select("shot", "pv", "value")


# masks and images


MASKS = "a AS (SELECT row, col, CASE WHEN (row + col) % 5 = 0 THEN 0 ELSE 1 END AS value FROM image WHERE row < 40), b AS (SELECT row, col, CASE WHEN row % 3 = 0 THEN 0 ELSE 1 END AS value FROM image WHERE col < 50), m AS (SELECT row, col, coalesce(a.value, 1) * coalesce(b.value, 1) AS value FROM a FULL JOIN b USING (row, col))"


def _mask(spark: SparkSession, d: str) -> DataFrame:
    i = image(spark, d)
    a = i.where("row < 40").select("row", "col", F.when((F.col("row") + F.col("col")) % 5 == 0, 0).otherwise(1).alias("value"))
    return masks.combined(a, i.where("col < 50").select("row", "col", F.when(F.col("row") % 3 == 0, 0).otherwise(1).alias("value")))


@query(f"WITH {IMAGE}, {MASKS} SELECT row, col, 1 - value AS value FROM m")
def mask_product_inverted(spark: SparkSession, d: str) -> DataFrame:
    return masks.inverted(_mask(spark, d))


@query(f"WITH {IMAGE}, {MASKS} SELECT i.row, i.col, round(i.value * coalesce(m.value, 1), 4) AS value FROM image AS i LEFT JOIN m USING (row, col)")
def mask_applied(spark: SparkSession, d: str) -> DataFrame:
    return masks.applied(image(spark, d), _mask(spark, d)).select("row", "col", F.round("value", 4).alias("value"))


@query(f"WITH {PIXELS} SELECT iy AS row, ix AS col, arg_max(v, shot * 100000000 + v) AS value FROM pixels GROUP BY ALL")
def assemble_last_write(spark: SparkSession, d: str) -> DataFrame:
    p = pixels(spark, d).withColumn("order", F.struct("shot", "v"))
    return images.assemble_last(p, "order")


@query("SELECT p_partkey AS pix_idx, p_retailprice AS value, p_size % 7 AS ix, p_size % 5 AS iy FROM part")
def pixels_with_coordinates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumnRenamed("p_partkey", "pix_idx")
    return images.coordinates_joined(p.select("pix_idx", F.col("p_retailprice").alias("value")), p.select("pix_idx", (F.col("p_size") % 7).alias("ix"), (F.col("p_size") % 5).alias("iy")))


@query(f"WITH {PIXELS}, p AS (SELECT CASE WHEN shot % 10 >= 2 THEN 'hit' ELSE 'miss' END AS kind, iy AS row, ix AS col, v FROM pixels) SELECT kind, row, col, greatest(0, max(v)) AS value FROM p GROUP BY ALL")
def powders_of_parts(spark: SparkSession, d: str) -> DataFrame:
    p = pixels(spark, d).select(F.col("iy").alias("row"), F.col("ix").alias("col"), F.col("v").alias("value"), "shot")
    return hits.merged_powders([images.powder_max(p.where(F.col("shot") % 3 == k), F.col("shot") % 10) for k in range(3)])


@query(f"WITH {PROFILES}, v AS (SELECT shot, unnest(p) AS x FROM profiles) SELECT shot, round(sum(round(abs(x) * 5) * sign(x) / 5), 6) + 0.0 AS total FROM v GROUP BY shot")
def quantised_images(spark: SparkSession, d: str) -> DataFrame:
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8)))
    q = images.quantised(profile_shots(spark, d).select("shot", F.array(rows).alias("image")), 0.1)
    return q.select("shot", (F.round(N.array_total(F.flatten(F.flatten("image"))), 6) + 0.0).alias("total"))


@query(f"WITH {PROFILES} SELECT shot, (q_idx // 8) AS row, q_idx % 8 AS col, v AS value FROM cells WHERE v > 0.1")
def sparsified_images(spark: SparkSession, d: str) -> DataFrame:
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("p", i * 8 + 1, F.lit(8)))
    p = profile_shots(spark, d).select("shot", rows.alias("image"))
    return kernels.sparsified(p, ["shot"], threshold=0.1).select("shot", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value")


@query("SELECT count(*) AS events, count(*) FILTER (label % 3 = 0) AS no_image FROM embeddings")
def events_without_image(spark: SparkSession, d: str) -> DataFrame:
    return peaks.image_counts(table(spark, d, "embeddings").select(F.when(F.col("label") % 3 != 0, F.col("embedding")).alias("image")))


# hits


HITS = """h AS (SELECT l_orderkey AS shot, CAST(l_linenumber % 2 AS INTEGER) AS seg, CAST(l_partkey % 16 AS INTEGER) AS row, CAST(l_suppkey % 16 AS INTEGER) AS col,
  l_quantity AS amax, l_extendedprice AS atot, l_linenumber AS n FROM lineitem)"""


@query(f"""WITH {HITS}, r AS (SELECT *, CASE WHEN row < 12 THEN sqrt(pow(col + 0.5 - 7.5, 2) + pow(seg * 16 + row + 0.5 - 15.5, 2)) END AS radius FROM h)
SELECT shot, CAST(count(*) AS INTEGER) AS "nPeaks", CAST(9.5 + shot % 3 AS DOUBLE) AS photon_energy_eV, string_agg(col, ',' ORDER BY n, seg, row, col, amax, atot) AS xs, string_agg(seg * 16 + row, ',' ORDER BY n, seg, row, col, amax, atot) AS ys,
round(coalesce(sum(radius), 0), 6) AS radius, CAST(count(radius) AS INTEGER) AS n_radius, round(max(amax), 6) AS strongest FROM r GROUP BY shot""")
def hit_records(spark: SparkSession, d: str) -> DataFrame:
    i = lambda c: c.cast("int")
    peak = F.struct(F.col("l_linenumber").alias("n"), i(F.col("l_linenumber") % 2).alias("seg"), i(F.col("l_partkey") % 16).alias("row"), i(F.col("l_suppkey") % 16).alias("col"), F.col("l_quantity").alias("amax"), F.col("l_extendedprice").alias("atot"), *[F.lit(0).alias(c) for c in ("rcent", "ccent", "rmin", "rmax", "cmin", "cmax")])
    found = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("shot")).agg(F.array_sort(F.collect_list(peak)).alias("peaks"))  # seven lines an order
    grid = spark.range(0, 512).select(*[i(c).alias(n) for c, n in ((F.floor(F.col("id") / 256), "seg"), (F.floor(F.col("id") / 16) % 16, "row"), (F.col("id") % 16, "col"))]).where("row < 12")
    where = grid.withColumns({"ix": F.col("col"), "iy": F.col("seg") * 16 + F.col("row")})
    r = hits.hit_records(found.withColumn("photon_energy_eV", 9.5 + F.col("shot") % 3), where, 16, 7.5, 15.5)
    known = F.filter("peakRadius", lambda x: x.isNotNull())
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return r.select("shot", "nPeaks", F.round("photon_energy_eV", 6).alias("photon_energy_eV"), text("peakXPosRaw").alias("xs"), text("peakYPosRaw").alias("ys"), F.round(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), 6).alias("radius"), F.size(known).alias("n_radius"), F.round(F.array_max("peakMaxIntensity"), 6).alias("strongest"))


@query("SELECT event_id AS shot, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS \"machineTime\", CAST((epoch_us(ts) % 1000000) * 1000 AS BIGINT) AS \"machineTimeNanoSeconds\" FROM events")
def hit_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("shot"), *hits.machine_time(F.col("ts")))


# curves


CURVES = f"""{SHOTS}, c AS (SELECT user_id % 4 AS curve, scan, avg(ipm) AS y FROM shots GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY curve ORDER BY scan) - 1 AS i, count(*) OVER (PARTITION BY curve) AS n FROM c),
 t AS (SELECT a.curve, a.scan, a.i, sum(b.y) AS s FROM r AS a JOIN r AS b ON a.curve = b.curve AND b.i BETWEEN (a.n - 1) // 2 + a.i - a.n // 2 + 1 AND (a.n - 1) // 2 + a.i GROUP BY ALL)"""


@query(f"WITH {CURVES}, m AS (SELECT curve, max(s) AS top FROM t GROUP BY curve) SELECT t.curve, CAST(min(i) AS INTEGER) AS center, CAST(min(scan) AS DOUBLE) AS t0, round(top, 6) AS top FROM t JOIN m ON t.curve = m.curve AND s >= top - 1e-9 GROUP BY t.curve, top")
def overlap_step_traces(spark: SparkSession, d: str) -> DataFrame:
    curve = shots(spark, d).groupBy((F.col("user_id") % 4).alias("curve"), "scan").agg(F.avg("ipm").alias("y")).withColumn("x", F.col("scan").cast("double"))
    return fits.step_traces(curve, ["curve"], "x", "y").select("curve", "center", "t0", F.round(F.array_max("trace"), 6).alias("top"))


@query(f"""WITH {PROFILES}, m AS (SELECT q_idx, avg(v) AS v FROM cells GROUP BY q_idx), n AS (SELECT *, lag(v) OVER (ORDER BY q_idx) AS a, lead(v) OVER (ORDER BY q_idx) AS b FROM m)
SELECT q_idx FROM n WHERE v > a AND v > b AND v >= 0 ORDER BY v DESC, q_idx LIMIT 1""")
def solvent_maximum(spark: SparkSession, d: str) -> DataFrame:
    mean = profile_shots(spark, d).select(F.posexplode("p").alias("q_idx", "v")).groupBy("q_idx").agg(F.avg("v").alias("v"))
    return spark.createDataFrame([(fits.solvent_maximum(mean, "q_idx", "v", 0.0),)], "q_idx long")


# ledger and small tables


@query(f"WITH {LEDGER} SELECT out_value FROM entries WHERE status = 'COMPLETED' AND tag = '1-URGENT' AND exec_cfg_id = 3")
def ledger_select(spark: SparkSession, d: str) -> DataFrame:
    return ledger.selected(entries(spark, d), "out_value", {"status": "COMPLETED", "tag": "1-URGENT", "exec_cfg_id": 3})


@query(f"WITH {LEDGER} SELECT (SELECT arg_max(out_value, id) FROM entries WHERE valid_flag = 1 AND tag = '2-HIGH') AS out_value")
def ledger_first_known(spark: SparkSession, d: str) -> DataFrame:
    e = entries(spark, d)
    return ledger.first_known([ledger.latest_entry(e.where(F.col("tag") == t), "out_value") for t in ("none", "nothing", "2-HIGH", "1-URGENT")], "out_value")


@query("SELECT o_custkey AS key, max(o_orderkey) AS t, arg_max(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1")
def latest_values_by_key(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("t"), F.col("o_totalprice").alias("v"))
    return sinks.latest_values(o, ["key"], "t")


@query("SELECT c_custkey AS run FROM customer WHERE c_mktsegment = 'BUILDING'")
def runs_by_tag(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("run"), F.array(F.lit("all"), "c_mktsegment").alias("tags"))
    return sinks.runs_with_tag(c, "BUILDING").select("run")


@query("SELECT n_nationkey AS id, 'SLURM_A=' || n_nationkey || ';SLURM_B=' || n_name AS env, CASE WHEN n_nationkey * 9 > 120 THEN '--ntasks=120' ELSE '--ntasks=' || n_nationkey * 9 END || ' -N 1' AS args FROM nation")
def environment_and_arguments(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").withColumn("env", F.create_map(F.lit("SLURM_B"), "n_name", F.lit("HOME"), F.lit("x"), F.lit("SLURM_A"), F.col("n_nationkey").cast("string")))
    args = F.concat(F.lit("--ntasks="), (F.col("n_nationkey") * 9).cast("string"), F.lit(" -N 1"))
    return sinks.environment(n).select(F.col("n_nationkey").alias("id"), "env", sinks.capped_tasks(args, 120).alias("args"))


@query("SELECT event_id AS id, 'both=' || CASE WHEN event_id % 2 = 0 THEN 'json' ELSE 'base' END || CASE WHEN event_id % 2 = 0 THEN ';k=' || (props :: JSON ->> '$.k') ELSE '' END || ';type=' || event_type AS merged FROM events")
def maps_merged(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: c.cast("string")
    base = F.create_map(F.lit("type"), "event_type", F.lit("both"), F.lit("base"))
    parsed = F.map_filter(F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("both"), F.lit("json"))), lambda k, _: k.isin("k", "both"))
    m = sinks.merged_maps(base, F.when(F.col("event_id") % 2 == 0, parsed))
    text = F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", s(e["key"]), s(e["value"]))), ";")
    return table(spark, d, "events").select(F.col("event_id").alias("id"), text.alias("merged"))


# text


@query("SELECT l_orderkey AS k, l_linenumber AS n, round(l_quantity + l_discount, 6) AS total, l_shipmode IS NULL AS bad FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 1 END AS l_shipmode FROM lineitem)")
def delimited_numbers(spark: SparkSession, d: str) -> DataFrame:
    bad = F.when(F.col("l_linenumber") % 3 == 0, "word").otherwise("1e0")
    line = F.concat_ws(",", F.concat(F.lit(" "), F.col("l_quantity").cast("string")), F.col("l_discount").cast("string"), bad)
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), numbers(line).alias("x"))
    at = lambda i: F.get("x", F.lit(i))
    return rows.select("k", "n", F.round(at(0) + at(1), 6).alias("total"), at(2).isNull().alias("bad"))


@query("SELECT page_id AS id, regexp_extract(url, '[^/]*$') AS base, regexp_extract(url, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(regexp_extract(url, '[^/]*$'), '^.+([.][^.]*)$', 1) AS ext, regexp_extract(url, '[^.]*$') AS last FROM pages WHERE url IS NOT NULL")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").where("url is not null").select(F.col("page_id").alias("id"), textscan.base_name(u).alias("base"), textscan.folder_name(u).alias("folder"), textscan.extension(u).alias("ext"), textscan.last_token(u, ".").alias("last"))


@query("SELECT event_id AS n FROM events WHERE (event_id < 100 AND event_id % 10 = 0) OR (event_id < 1000 AND event_id % 100 = 0) OR event_id % 1000 = 0")
def progress_steps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(reductions.progress_step(F.col("event_id"))).select(F.col("event_id").alias("n"))
