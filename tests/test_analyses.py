import numpy as np
import pytest
from pyspark.sql import functions as F

from shotframe.functions import numeric
from shotframe.operators import images, kernels, sinks
from shotframe.plans import analyses, parameters
from shotframe.plans.pipeline import COMPLETED, WORKFLOWS

IMAGE = "array<array<double>>"


@pytest.fixture(scope="module")
def shots(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(120):
        area = rng.uniform(0, 1, (6, 12))
        area[:, 5] += 5 + (i % 2)
        rows.append((i, int(i % 10 != 0), i % 2, 2000.0, float(i % 3), rng.uniform(1, 2, (2, 8)).tolist(), float(rng.uniform(1, 2)), 7.0 + (i % 5) * 0.01, 7.0 + (i % 5) * 0.01, area.tolist()))
    path = str(tmp_path_factory.mktemp("shots") / "t")
    df = spark.createDataFrame(rows, f"shot long, xray int, laser int, `ipm5/sum` double, `scan/lens_v` double, azav {IMAGE}, xas_raw double, ccm double, ccm_set double, roi_area {IMAGE}")
    df.write.parquet(path)
    spark.createDataFrame([(i, 0.5 + 0.5 * i) for i in range(8)], "idx int, q double").write.parquet(f"{path}.q")
    return path, rows


def test_graph_of_analyses(spark, shots):
    path, rows = shots
    base = {"path": path, "ipm": "ipm5/sum", "scan": "lens_v", "thresholds": {"min_iscat": 1.0}}
    energy = base | {"energy": "ccm", "set_point": "ccm_set"}
    out = WORKFLOWS["shots"].run(spark, {"scattering": base, "overlap": base, "absorption": energy, "absorption_scan": energy, "emission": base})
    assert all(r.task_status == COMPLETED for r in out.values()), [r.summary for r in out.values()]
    assert out["scattering"].payload.count() == 3 * 8
    assert out["overlap"].payload.count() == 1 and out["absorption_scan"].payload.count() == 3
    az, raw, e = np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), np.array([r[7] for r in rows])
    x0, l0 = (np.array([r[k] for r in rows]) == 1 for k in (1, 2))
    norm = az[:, :, 3:6].mean((1, 2))  # q strictly between 1.5 and 3.5
    c = np.unique(e)
    edges = np.concatenate((c[:1], (c[1:] + c[:-1]) / 2, c[-1:]))
    absorbed = {r.bin: r for r in out["absorption"].payload.collect()}
    assert len(absorbed) == 5
    for k, r in absorbed.items():
        at = x0 & (e >= edges[k]) & ((e < edges[k + 1]) if k < 4 else (e <= edges[5]))
        assert (r.on, r.off) == pytest.approx(tuple((raw / norm)[at & x].mean() if (at & x).any() else 0.0 for x in (l0, ~l0)))
    fast = base | {"scan": "lxt_fast"}
    spark.read.parquet(path).withColumnRenamed("scan/lens_v", "scan/lxt_fast").write.mode("overwrite").parquet(path + "f")
    spark.read.parquet(path + ".q").write.mode("overwrite").parquet(path + "f.q")
    got = analyses.scattering(spark, fast | {"path": path + "f", "bins": 4}).collect()
    assert len(got) == 5 * 8 and all(r["diff"] == 0 for r in got if r.scan == 2.0)  # five edges; nothing falls beyond the last
    got = {(r.scan, r.pixel): r["diff"] for r in out["emission"].payload.collect()}
    a = np.array([r[9] for r in rows])
    g = int(a.sum((0, 1)).argmax())
    spec = a[:, :, max(0, g - 5) : g + 5].sum(2) / 2000.0
    x, l, s = (np.array([r[k] for r in rows]) for k in (1, 2, 4))
    for (scan, pixel), d in got.items():
        want = spec[(x == 1) & (l == 1) & (s == scan), pixel].mean() - spec[(x == 1) & (l == 0) & (s == scan), pixel].mean()
        assert d == pytest.approx(want)


@pytest.mark.parametrize("name", ["lens_v", "lxt"])
def test_overlap_equals_numpy(spark, tmp_path, name):
    rng = np.random.default_rng(31)
    n, q = 900, np.arange(30) * 0.15
    scan = rng.integers(0, 24, n) / 10.0
    xray, laser = rng.random(n) < 0.95, rng.random(n) < 0.5
    ring = 3 * np.exp(-((q - 1.8) ** 2) / 0.1)  # the solvent
    gain = np.where(laser, 0.6 * np.exp(-((scan - 1.1) ** 2) / 0.08) if name == "lens_v" else 0.5 * (scan > 1.25), 0.0)
    az = (1 + ring + gain[:, None] * np.exp(-((q - 3.3) ** 2) / 0.2))[:, None, :] * rng.uniform(0.9, 1.1, (n, 2, 1)) + rng.normal(0, 0.01, (n, 2, 30))
    az = np.where(xray[:, None, None], az, 0.05 + 0.001 * np.arange(30))
    az[5, 1, 7] = np.nan
    path = str(tmp_path / "t")
    det = [(i, int(a), int(b), 2000.0, float(s), p.tolist(), q.tolist()) for i, (a, b, s, p) in enumerate(zip(xray, laser, scan, az, strict=True))]
    spark.createDataFrame(det, f"shot long, `lightStatus/xray` int, `lightStatus/laser` int, `ipm5/sum` double, `scan/{name}` double, `Rayonix/pyfai_azav` {IMAGE}, `Rayonix/pyfai_q` array<double>").write.parquet(path)
    values = {"path": path, "ipm": "ipm5/sum", "scan": name, "thresholds": {"min_iscat": 1.0, "min_ipm": 1000.0}}
    r = analyses.overlap(spark, values).first()
    p = np.nansum(az, 1)
    dark = p[~xray].mean(0)
    norm = np.nanmean(np.nanmean(az[:, :, (q > 0.9) & (q < 3.5)], 2), 1)
    v = (p - dark) / norm[:, None]
    keep = xray & (np.nansum(az, (1, 2)) > 1.0)
    mean = np.nansum(v[keep & laser], 0) / n
    tops = [i for i in range(1, 29) if mean[i - 1] < mean[i] > mean[i + 1] and mean[i] >= 1]
    at = min((max(tops, key=lambda i: mean[i]) if tops else int(mean.argmax())) + 10, 29)
    bins = np.unique(scan)
    curve = np.array([v[keep & laser & (scan == b), at].mean() - v[keep & ~laser & (scan == b), at].mean() for b in bins])
    assert r.scan_name == name and r.q_idx == at and r.bins == pytest.approx(bins.tolist()) and r.curve == pytest.approx(curve.tolist())
    if name == "lxt":
        kernel = np.zeros(len(bins))
        kernel[: len(bins) // 2] = 1
        trace = np.convolve(curve, kernel, mode="same")
        assert r.trace == pytest.approx(trace.tolist()) and r.position == bins[trace.argmax()]
        assert r.fwhm == pytest.approx(numeric.fwhm(bins, trace, np.arange(float(len(bins)))))
    else:
        fit = numeric.fit_gaussian(bins, curve)
        assert r.trace is None and (r.position, r.fwhm) == pytest.approx((fit["center"], fit["sigma"] * 2.3548200), rel=1e-4)
        assert r.position == pytest.approx(1.1, abs=0.05)


def test_find_peaks_task(spark, tmp_path):
    image = np.zeros((20, 20))
    image[5, 5], image[5, 6], image[12, 12], image[12, 13] = 300, 250, 400, 200
    spark.createDataFrame([(0, [image.tolist()], [1]), (1, [np.zeros((20, 20)).tolist()], [2])], "shot long, image array<array<array<double>>>, event_codes array<int>").write.parquet(str(tmp_path / "in"))
    out = analyses.find_peaks(spark, {"path": str(tmp_path / "in"), "out": str(tmp_path / "out"), "tag": "t"})
    assert [r.shot for r in out.collect()] == [0]
    assert spark.read.text(str(tmp_path / "out" / "t.list")).first().value.endswith("/t")


def test_parameters(monkeypatch):
    monkeypatch.setenv("RUN_NUM", "12_x")
    assert parameters.Header(experiment="abcx1").run == 12 and parameters.Header(experiment="abcx1").hutch == "abc"
    with pytest.raises(ValueError):
        parameters.build(parameters.Peaks, {"min_peaks": 5, "max_peaks": 1})
    with pytest.raises(TypeError, match="foo"):
        parameters.build(parameters.Peaks, {"foo": 5})
    assert ("ipm", "str", "required") in parameters.describe(parameters.Scattering)


def test_kernels(spark):
    m = np.zeros((6, 7))
    m[1, 1], m[1, 2], m[4, 5] = 100.0, 80.0, 30.0
    df = spark.createDataFrame([(0, m.tolist()), (1, None)], f"shot int, image {IMAGE}")
    d = kernels.droplet_photons(kernels.droplets(df)).orderBy("shot").collect()
    assert len(d[0].droplets) == 1 and d[0].droplets[0].npix == 2 and d[0].photons == 1 and d[1].droplets is None
    c = np.array(kernels.autocorrelation(df).where("shot = 0").first().correlation)
    assert c.argmax() == 3 * 7 + 3 and c.max() == pytest.approx((m**2).sum())
    assert np.allclose(kernels.reconstructed(df).where("shot = 0").first().fitted, m)
    assert kernels.sparsified(df, ["shot"]).count() == 3
    y = np.sin(np.arange(100) * 0.05) + np.where(np.arange(100) % 2, 0.3, -0.3)
    assert np.abs(kernels.lowpass(y) - np.sin(np.arange(100) * 0.05))[5:-5].max() < 0.05
    q = images.quantised(spark.createDataFrame([([[[1.0, 14.0, None]]],)], f"image array<{IMAGE}>"), 5.0).first().image
    assert q == [[[0.0, 10.0, None]]]


def test_sinks(spark, tmp_path):
    assert sinks.specification({"a": 1, "b": None, "c": "x"}) == ["a=1", "c=x"]
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 1, "c")], "key string, t int, v string")
    assert {r.key: r.v for r in sinks.latest_values(rows, ["key"], "t").collect()} == {"k": "b", "l": "c"}
    env = spark.createDataFrame([({"SLURM_A": "1", "HOME": "x", "SLURM_B": "2"},)], "env map<string,string>")
    assert sinks.environment(env).first().env == "SLURM_A=1;SLURM_B=2"
    assert spark.range(1).select(sinks.capped_tasks(F.lit("--ntasks=200 -N 1"), 120)).first()[0] == "--ntasks=120 -N 1"
    assert sinks.runs_with_tag(spark.createDataFrame([(1, ["a"]), (2, ["b"])], "run int, tags array<string>"), "a").count() == 1
