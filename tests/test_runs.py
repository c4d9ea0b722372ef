import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotframe.functions import numeric
from shotframe.operators import fits, hits, kernels, masks, sinks
from shotframe.operators.ledger import Ledger
from shotframe.plans.lineage import filled, filled_by_run
from shotframe.plans.pipeline import COMPLETED, FAILED, Task, html_report
from shotframe.sources import instrument, shots
from shotframe.streaming import reductions

POWDER = "kind string, row int, col int, value double"


def test_parts_of_a_run(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    mask = spark.createDataFrame([(0, 0, 1), (0, 1, 0)], "row int, col int, value int")
    none = spark.range(0).withColumnRenamed("id", "shot")
    hits.write_part(none, spark.createDataFrame([("hit", 0, 0, 3.0)], POWDER), mask, a)
    hits.write_part(none, spark.createDataFrame([("hit", 0, 0, 2.0)], POWDER), None, b)
    with pytest.raises(ValueError, match="no hits"):
        hits.read_run(spark, [a, b])
    hits.write_part(spark.range(5, 7).withColumnRenamed("id", "shot"), spark.createDataFrame([("hit", 0, 0, 9.0), ("miss", 0, 0, 1.0)], POWDER), None, b)
    found, powders = hits.read_run(spark, [a, b])
    assert sorted(r.shot for r in found.collect()) == [5, 6]
    assert sorted(map(tuple, powders.collect())) == [("hit", 0, 0, 9.0), ("miss", 0, 0, 1.0)]
    assert sorted(map(tuple, spark.read.parquet(f"{a}/mask").collect())) == [(0, 0, 0), (0, 1, 1)]


def test_hit_without_peaks_has_empty_lists(spark):
    peak = "seg int, row int, col int, npix int, amax double, atot double, rcent double, ccent double, rmin int, rmax int, cmin int, cmax int, son double"
    found = spark.createDataFrame([(1, [(0, 2, 3, 2, 9.0, 11.0, 2.0, 3.0, 1, 2, 3, 4, 8.0)]), (2, [])], f"shot int, peaks array<struct<{peak}>>")
    where = spark.createDataFrame([(0, 2, 3, 3, 2)], "seg int, row int, col int, ix int, iy int")
    one, two = hits.hit_records(found, where, 16, 0.5, 2.5).orderBy("shot").collect()
    assert one.nPeaks == 1 and one.peakXPosRaw == [3] and one.peakYPosRaw == [2] and one.peakRadius == [3.0] and one.peakMaxIntensity == [9.0]
    assert two.nPeaks == 0 and two.peakRadius == [] and two.rcent == []


def test_masks(spark, tmp_path):
    assert shots.read_mask(spark, None) is None
    np.save(tmp_path / "m.npy", np.array([[1, 0], [1, 1]]))
    m = shots.read_mask(spark, str(tmp_path / "m.npy"))
    assert masks.combined(m, None) is m and masks.applied(m, None) is m
    pixels = spark.createDataFrame([(0, 0, 5.0), (0, 1, 6.0), (9, 9, 7.0)], "row int, col int, value double")
    assert sorted(map(tuple, masks.applied(pixels, m).collect())) == [(0, 0, 5.0), (0, 1, 0.0), (9, 9, 7.0)]


def test_slow_values_at_edges(spark):
    make = lambda rows, c: spark.createDataFrame(rows, f"pv string, s int, {c}").withColumn("ts", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s)")).drop("s")
    changes = make([("a", 10, 1.0), ("a", 10, 2.0), ("a", 9000, 3.0), (None, 0, 4.0)], "value double")
    s = make([("a", 9, 0), ("a", 10, 1), ("a", 8999, 2), ("a", 9000, 3), ("a", 99999, 4), (None, 5, 5), ("b", 50, 6)], "shot int")
    for span in (7, 3600, 10**7):
        out = instrument.slow_values(s, changes, span=span)
        assert {r.shot: r.value for r in out.collect()} == {0: None, 1: 2.0, 2: 2.0, 3: 3.0, 4: 3.0, 5: 4.0, 6: None}
    assert instrument.slow_values(s, changes.limit(0)).where("value is not null").count() == 0
    assert instrument.slow_values(s.limit(0), changes).count() == 0


def test_small_files(spark, tmp_path):
    sinks.write_list(spark, ["x/1", "x/2"], str(tmp_path / "t.list"))
    assert (tmp_path / "t.list").read_text() == "x/1\nx/2\n"
    sinks.write_numbers(spark.createDataFrame([(1, 0.5), (2, None)], "a int, b double"), ["a", "b"], str(tmp_path / "n"))
    got = sorted(r["values"] for r in shots.read_numbers(spark, str(tmp_path / "n")).collect())
    assert got[0] == [1.0, 0.5] and got[1][0] == 2.0 and math.isnan(got[1][1])
    assert instrument.wait_for_files(spark, str(tmp_path / "*.list"), 0.01, 1)[0].endswith("t.list")
    with pytest.raises(TimeoutError):
        instrument.wait_for_files(spark, str(tmp_path / "*.none"), 0.01, 2)
    report = html_report(str(tmp_path), "r", {"t": spark.range(4)}, rows=3)
    assert "there are more" in open(report).read()
    assert "there are more" not in open(html_report(str(tmp_path), "s", {"t": spark.range(3)}, rows=3)).read()


def test_empty_parameters_come_from_the_ledger(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"))
    assert filled(led, "scattering", {"path": ""}) == {"path": ""}
    head, run = {"experiment": "e1", "run": "3"}, {"env": "A"}
    led.record("scattering", head, run, {"path": "own"}, {"task_status": "COMPLETED", "payload": "s"})
    assert filled(led, "emission", {"path": "", "bins": 3}) == {"path": "own", "bins": 3}
    led.record("shots", head, run, {}, {"task_status": "COMPLETED", "payload": "table"})
    assert filled(led, "emission", {}) == {"path": "table"} and filled(led, "emission", {"path": "given"}) == {"path": "given"}
    assert filled(led, "emission", {"path": ""}, run="9") == {"path": ""}
    made = Task("w", lambda s, p: None, result_from="out")
    assert made.run(spark, {"out": "file"}).payload == "file" and made.run(spark, {}).task_status == FAILED
    assert Task("v", lambda s, p: 3).run(spark, {}).task_status == COMPLETED


def test_parameters_of_merging_and_solving(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"))
    for run in ("3", "4"):
        head, own = {"experiment": "e1", "run": run}, {"env": "A"}
        led.record("index", head, own, {"out_file": f"/w/e1_r{run}_tag.stream", "cell_file": "lyso.cell"}, {"task_status": "FAILED"})
        led.record("merge", head, own, {"out_file": f"/w/r{run}.hkl", "symmetry": "422"}, {"task_status": "COMPLETED"})
        led.record("merge", head, own, {"out_file": "/w/bad.hkl", "symmetry": "1"}, {"task_status": "FAILED"})
        led.record("manipulate", head, own, {"out_file": f"/x/r{run}.mtz"}, {"task_status": "COMPLETED"})
    empty = {"in_files": "", "cell_file": "", "symmetry": "", "shell_file": "", "fom": "Rsplit", "nshells": 10}
    want = {"in_files": "/w/r3.hkl1 /w/r3.hkl2", "cell_file": "lyso.cell", "symmetry": "422", "shell_file": "/w/r3_Rsplit_n10.dat"}
    assert filled(led, "compare", empty, run="3") == empty | want
    assert filled(led, "solve", {}, run="4") == {"in_file": "/x/r4.mtz", "out_dir": "/x"}
    assert filled(led, "prepare", {}, run="4") == {"in_file": "</x/r4.mtz"} and filled(led, "manipulate", {"in_file": "a"}, run="4")["out_file"] == "/w/r4.mtz"
    assert filled(led, "concatenate", {}) == {}  # indexing failed
    tables = {t: led.table(t) for t in ("index", "merge", "manipulate")}
    for task in ("compare", "solve", "prepare", "manipulate", "merge"):
        got = {}
        for r in filled_by_run(tables, led.table("gen_cfg"), task, empty).collect():
            got.setdefault(r.run, {})[r.parameter] = r.value
        assert all(filled(led, task, dict(empty), run=run) == empty | got.get(run, {}) for run in ("3", "4"))


def test_steps_over_images(spark):
    df = spark.createDataFrame([(0, [[0.0, 200.0], [0.0, 190.0]])], "shot int, image array<array<double>>")
    out = kernels.stacked(df, kernels.droplets, kernels.droplet_photons, lambda d: d.drop("image"))
    assert out.columns == ["shot", "droplets", "photons"] and out.first().photons == 2


def test_width_of_a_trace(spark):
    y = [0.0] * 10 + [1.0] * 10
    r = fits.step_traces(spark.createDataFrame([("c", float(i) / 10, v) for i, v in enumerate(y)], "k string, x double, y double"), ["k"], "x", "y").first()
    want = np.convolve(y, [1.0] * 10 + [0.0] * 10, mode="same")
    assert r.trace == pytest.approx(want.tolist()) and r.center == int(want.argmax()) and r.t0 == pytest.approx(r.center / 10)
    x = np.arange(9) / 10
    tent = np.array([0, 1, 2, 3, 4, 3, 2, 1, 0.0])
    assert numeric.fwhm(x, tent + 0.1, np.arange(9.0)) == pytest.approx(4.1, abs=0.05)  # by the spline; straight lines give 4.1
    assert numeric.fwhm(x, tent + 0.1) == pytest.approx(numeric.fwhm(x, tent + 0.1, np.arange(9.0)) / 10)


def test_windows_into_files(spark, tmp_path):
    make = lambda lo, hi: spark.range(lo, hi).select((F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp").alias("ts"), (F.col("id") % 2 == 0).alias("h"))
    make(0, 300).write.parquet(str(tmp_path / "in"))
    live = lambda: reductions.stream_hit_counts(reductions.live_shots(spark, str(tmp_path / "in"), "ts timestamp, h boolean"), F.col("h"))
    reductions.run_to_files(live(), str(tmp_path / "out"), str(tmp_path / "ck"))
    first = {r.start: (r.events, r.hits) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    make(300, 600).write.mode("append").parquet(str(tmp_path / "in"))
    reductions.run_to_files(live(), str(tmp_path / "out"), str(tmp_path / "ck"))
    both = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < len(first) < both.count() and both.groupBy("start").count().where("count > 1").count() == 0
    whole = make(0, 600).groupBy(F.window("ts", "1 hour").start.alias("start")).agg(F.count("*").alias("events"), F.count_if("h").alias("hits"))
    want = {r.start: (r.events, r.hits) for r in whole.collect()}
    assert all(want[r.start] == (r.events, r.hits) for r in both.collect())
    assert reductions.counted(make(0, 10), "progress", F.col("h")).count() == 10
