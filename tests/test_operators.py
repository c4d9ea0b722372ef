import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N
from shotframe.functions import numeric as K
from shotframe.functions import splines
from shotframe.operators import binning, differences, filters, fits, geometry, images, peaks, profiles, textscan

INF, NAN = math.inf, math.nan


def one(df):
    return df.first()[0]


@pytest.mark.parametrize("a,b,want", [(1.0, 0.0, INF), (-1.0, 0.0, -INF), (0.0, 0.0, NAN), (NAN, 0.0, NAN), (3.0, 2.0, 1.5), (None, 0.0, None), (1.0, NAN, NAN)])
def test_divide(spark, a, b, want):
    got = one(spark.createDataFrame([(a, b)], "a double, b double").select(N.divide(F.col("a"), F.col("b"))))
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_nan_rules(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (3.0,), (None,), (INF,)], "x double")
    x = F.col("x")
    assert one(df.where("x is null or x < 10 or isnan(x)").agg(N.mean(x))) == 2.0
    assert math.isnan(one(df.agg(N.mean(x, skip_nan=False))))
    assert one(df.agg(F.count_if(N.above(x, 2.0)))) == 2
    assert one(df.agg(N.largest(x))) == INF
    assert sorted(r[0] for r in df.select(N.nan_to_num(x)).collect()) == [0.0, 0.0, 1.0, 3.0, N.HUGE]
    assert one(df.limit(0).agg(N.total(x))) == 0.0


def test_array_rules(spark):
    df = spark.createDataFrame([([1.0, NAN, 3.0],), ([NAN],), ([],)], "a array<double>")
    assert [r[0] for r in df.select(N.array_total(F.col("a"))).collect()] == [4.0, 0.0, 0.0]
    got = [r[0] for r in df.select(N.array_mean(F.col("a"))).collect()]
    assert got[0] == 2.0 and math.isnan(got[1]) and math.isnan(got[2])


def test_filters_ignore_unknown_names_and_pass_without_monitor(spark):
    df = spark.createDataFrame([(1, 1, NAN), (1, 1, 50.0), (0, 1, 50.0), (None, 1, 50.0)], "xray int, laser int, iscat double")
    f = filters.standard_filters(df)
    assert df.where(filters.combine(f, "xray on, laser on, total scattering, ipm, percentage")).count() == 1
    assert {r["filter"]: r.n_pass for r in filters.filter_counts(df, f).collect()}["total scattering"] == 3
    assert filters.shot_ranges(10, 3) == [(0, 0, 4), (1, 4, 7), (2, 7, 10)]


@pytest.mark.parametrize("closed", [False, True])
def test_bins(spark, closed):
    values = [0.0, 0.1, 0.3, 0.30000000000000004, 0.7, 1.0, NAN, None, -0.1, 1.1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for edges in ([i / 10 for i in range(11)], [0.0, 0.05, 0.3, 1.0]):
        got = [r[0] for r in df.select(binning.assign_bin(F.col("x"), edges, closed)).collect()]
        for v, b in zip(values, got, strict=True):
            want = None if v is None or math.isnan(v) else next((i for i in range(len(edges) - 1) if edges[i] <= v < edges[i + 1]), len(edges) - 2 if closed and v == edges[-1] else None)
            assert b == want, (v, edges)


def test_edges(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (NAN,), (None,), (3.0,)], "x double")
    assert binning.equal_width_edges(df, "x", 2) == [1.0, 2.0, 3.0]
    assert binning.midpoint_edges(df, "x") == [1.0, 2.0, 3.0]
    assert binning.equal_width_edges(df.where("x = 3"), "x", 2) == [2.5, 3.0, 3.5]
    assert binning.equal_width_edges(df.limit(0), "x", 2) == []
    assert [r.value for r in binning.distinct_values(df, "x").orderBy("bin").collect()] == [0.0, 1.0, 3.0]
    assert binning.ccm_edges(df, "x", None) == [1.0, 2.0, 3.0]


def test_empty_bins_get_rows_and_two_bins_no_spectrum(spark):
    df = spark.createDataFrame([(0.5, 2.0, True), (0.5, 4.0, False), (2.5, NAN, True)], "e double, v double, l boolean")
    out = differences.by_edges(df, F.col("e"), [0.0, 1.0, 2.0, 3.0], F.col("v"), F.col("l"), ~F.col("l"), clean=True).orderBy("bin").collect()
    assert [(r.on, r.off, r.diff) for r in out] == [(2.0, 4.0, -2.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    assert differences.absorption_by_energy(df, "e", [0.0, 1.0, 2.0], F.col("v"), F.col("l"), ~F.col("l")).count() == 0


def test_scattering_difference_equals_numpy(spark):
    rng = np.random.default_rng(5)
    az = rng.uniform(1, 2, (60, 3, 8))
    az[3, 1, 2] = az[7, 0] = NAN
    xray, laser, scan = np.arange(60) % 5 != 0, np.arange(60) % 2 == 0, (np.arange(60) % 4).astype(float)
    laser[scan == 1], laser[scan == 2] = True, False  # one-sided bins
    dropped = scan == 3  # an empty one
    rows = [(float(s), bool(x and y and not d), bool(x and not y and not d), bool(not x), p.tolist()) for s, x, y, d, p in zip(scan, xray, laser, dropped, az)]
    df = spark.createDataFrame(rows, "scan double, l boolean, o boolean, dark boolean, az array<array<double>>")
    axis = [float(i) for i in range(8)]
    out = profiles.scattering_difference(df, "az", axis, "scan", F.col("l"), F.col("o"), F.col("dark"), 0.9, 5.5).collect()
    p = np.nansum(az, axis=1)
    p = p - np.nanmean(p[~xray], axis=0)
    with np.errstate(all="ignore"):
        p = (p.T / np.nanmean(np.nanmean(az[..., 1:6], axis=-1), axis=-1)).T
    assert len(out) == 4 * 8
    for r in out:
        at = (scan == r.scan) & xray & ~dropped
        on, off = (np.nanmean(p[at & x, r.q_idx]) if (at & x).any() else NAN for x in (laser, ~laser))
        assert (r.on is None) == np.isnan(on) and (r.off is None) == np.isnan(off)
        assert r["diff"] == pytest.approx(np.nan_to_num(on) - np.nan_to_num(off))


def test_dark_of_one_value_is_zero(spark):
    df = spark.createDataFrame([([2.0, 2.0],), ([2.0, 2.0],)], "p array<double>")
    assert profiles.dark_array(profiles.dark_mean(df, "p", F.lit(True))) == [0.0, 0.0]


def test_images(spark):
    px = spark.createDataFrame([(5, 7, 1.0, 0), (5, 7, 2.0, 1), (6, 9, 4.0, 2)], "ix int, iy int, v double, k int")
    assert sorted(tuple(r) for r in images.assemble(px).collect()) == [(0, 0, 3.0), (2, 1, 4.0)]
    assert sorted(tuple(r) for r in images.assemble_last(px, "k").collect()) == [(7, 5, 2.0), (9, 6, 4.0)]
    im = spark.createDataFrame([(r, c, float(20 + r + c)) for r in range(5) for c in range(5)], "row int, col int, value double")
    got = {r.r: r.value for r in images.radial_profile(im, 2.0, 2.0).collect()}
    a = np.add.outer(np.arange(5), np.arange(5)) + 20.0
    assert got == pytest.approx(dict(enumerate(geometry.profile_of(a, 2.0, 2.0))))
    masked = {r.r: r.value for r in images.radial_profile(im, 2.0, 2.0, F.lit(0)).collect()}
    assert list(masked) == [0]
    assert images.brightest_window(im, 5) == (0, 9)
    geo = spark.createDataFrame([(0, 1), (1, 2)], "pix_idx int, ix int")
    values = spark.createDataFrame([(0, 1.0)], "pix_idx int, v double")
    with pytest.raises(Exception, match="differ in number"):
        images.coordinates_joined(values, geo).collect()


def test_rotation_by_a_right_angle(spark):
    m = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [7.0, 8.0, 9.0]]
    got = np.array(images.rotated(spark.createDataFrame([(m,)], "image array<array<double>>"), 90).first()[0])
    assert np.allclose(got, np.rot90(m, 1)) or np.allclose(got, np.rot90(m, -1))


def test_peaks(spark):
    image = np.zeros((30, 40))
    image[10, 12], image[10, 13], image[20, 30] = 500.0, 300.0, 90.0
    rng = np.random.default_rng(1)
    image += rng.uniform(0, 1, image.shape)
    df = spark.createDataFrame([(0, [image.tolist()]), (1, None)], "shot int, image array<array<array<double>>>")
    out = {r.shot: r for r in peaks.find_peaks(df).collect()}
    assert out[1].n_peaks == 0 and out[0].n_peaks == 1
    p = out[0].peaks[0]
    assert (p.row, p.col, p.npix) == (10, 12, 2) and p.ccent == pytest.approx(12.375, abs=0.02)
    t = peaks.peak_table(peaks.find_peaks(df), ["shot"], 30).first()
    assert t.image_row == 10
    empty = peaks.hit_summary(df.limit(0), F.lit(True)).first()
    assert (empty.events, empty.hits, empty.rate) == (0, 0, "0.00")


def test_local_peaks():
    y = np.array([0, 1, 0, 5, 5, 0, 3, 2.5, 3, 0.0])
    assert K.local_peaks(y, 1, 1).tolist() == [1, 3, 6, 8]
    assert K.local_peaks(y, 4, 1).tolist() == [3]
    assert K.local_peaks(np.array([]), 1, 1).tolist() == []
    assert K.local_peaks(np.array([0, 2, 0, 3, 0.0]), 1, 10).tolist() == [3]


def test_fits(spark):
    x = np.linspace(-5, 5, 60)
    y = K.gaussian(x, 3.0, 0.7, 0.9, 0.2)
    f = K.fit_gaussian(x, y)
    assert [f[k] for k in ("amp", "center", "sigma", "base")] == pytest.approx([3.0, 0.7, 0.9, 0.2], abs=1e-4)
    assert K.fwhm(x, y - 0.2) == pytest.approx(0.9 * 2.35482, rel=0.01)
    df = spark.createDataFrame([("a", float(i), float(j)) for i, j in zip(x, y, strict=True)], "k string, x double, y double")
    assert fits.gaussian_fits(df, ["k"], "x", "y").first().fwhm == pytest.approx(0.9 * 2.35482, rel=1e-3)
    assert "t0" in fits.overlap(df, ["k"], "x", "y", "lxt_ttc").columns
    assert fits.solvent_maximum(df.where("k = 'a'"), "x", "y") == pytest.approx(0.7, abs=0.1)


def test_geometry_search_finds_the_centre(spark):
    y, x = np.indices((120, 120))
    r = np.hypot(x - 61.0, y - 58.5)
    image = 100 + sum(400 * np.exp(-((r - k) ** 2) / 3) for k in (18, 36, 54))
    grid = geometry.center_grid(spark, (60.0, 60.0), [100.0], (-2, 2, 2), (-2, 2, 2))
    assert grid.count() == 4
    pixels = spark.createDataFrame([(int(a), int(b), float(v)) for a, b, v in zip(y.ravel(), x.ravel(), image.ravel(), strict=True)], "row int, col int, value double").repartition(3)
    found = geometry.search(grid, pixels, 1.0, 0.1, iterations=2)
    best = geometry.best_candidate(found).first()
    assert (best.cx, best.cy) == (pytest.approx(61.0, abs=0.6), pytest.approx(58.5, abs=0.6)) and found.count() == 8
    profiles_ = {r.candidate: r.profile for r in geometry.candidate_profiles(pixels, grid).collect()}
    for c in grid.collect():
        p = geometry.profile_of(image, c.cx, c.cy)
        assert profiles_[c.candidate] == pytest.approx(p.tolist())
        at = K.local_peaks(p, 1.0, 10)
        dq, score = geometry.score_rings((2 * np.sin(np.arctan(at * 0.1 / c.distance) / 2) / 1.0)[at >= 0])
        want = 2 * c.distance * np.arcsin(dq / 2) / np.tan(2 * np.arcsin(geometry.FIRST_RING / (2 * np.pi) / 2))
        got = geometry.inferred_distances(geometry.ring_peaks(geometry.candidate_profiles(pixels, grid)), grid, 1.0, 0.1).where(F.col("candidate") == c.candidate).first()
        assert (got.distance, got.score, got.n_rings) == (pytest.approx(want), pytest.approx(score, rel=1e-6), len(at))
    smooth = geometry.candidate_profiles(pixels, grid, -1e9, (2, 0.25)).where("candidate = 0").first().profile
    assert smooth == pytest.approx(splines.smoothed(np.array([geometry.profile_of(image, *[(c.cx, c.cy) for c in grid.where("candidate = 0").collect()][0], floor=-1e9)]))[0].tolist())


def test_ring_scores_in_tasks_and_in_sql_agree(spark):
    q = [0.0171, 0.0342, 0.0515, 0.0684]
    df = spark.createDataFrame([(v,) for v in q], "q double")
    got = geometry.best_spacing(geometry.ring_scores(df)).first()
    dq, score = geometry.score_rings(np.array(q))
    assert got.dq == pytest.approx(dq) and got.final_score == pytest.approx(score, rel=1e-6)


def test_text(spark):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(["; clen = 1", "; foo = 2", ";", "data = /entry_1/data_1/data", "p0/coffset = 1", "p0/res = 2"])], "line_no int, line string")
    got = [r.line for r in textscan.with_peak_lists(lines).orderBy("line_no").collect()]
    assert got == ["clen = 1", "; foo = 2", ";", "data = /entry_1/data_1/data", "", "peak_list = /entry_1/result_1", "peak_list_type = cxi", "p0/coffset = 1", "p0/res = 2"]
    assert [r.line for r in textscan.with_offset_and_resolution(lines, 0.5, 9.0).orderBy("line_no").collect()][-2:] == ["p0/coffset = 0.5", "p0/res = 9.0"]
    assert textscan.indexing_rate(lines).first().rate == "0.00"
    t = spark.createDataFrame([("  d fom CC num",), (" 2.0  0.5",), ("4.0 0.25 ",)], "line string")
    assert sorted(tuple(r) for r in textscan.shells(textscan.shell_table(t)).collect()) == [(2.5, 0.25), (5.0, 0.5)]
    assert textscan.figure_of_merit("a b CC") == "CC"
