"""Array files by ranges, streams of blocks, droplets, photons, peaks, splines and filters against plain versions."""

import os
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotframe import catalog_kernels
from shotframe.functions import numeric, splines
from shotframe.operators import droplets, geomfile, images, peaks
from shotframe.sources import shots, stacks
from shotframe.streaming import blocks, producer, reductions

IMAGE = "array<array<double>>"


# array files


@pytest.fixture()
def stack(spark, tmp_path):
    rows = spark.range(0, 100, 1, 3).select(F.col("id").alias("n"), (F.col("id") / 4).alias("ipm"), F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: (F.col("id") * 100 + i * 10 + j).cast("float"))).alias("det/area"), (F.col("id") % 2 == 0).alias("on"))
    folder = str(tmp_path / "s.stack")
    assert stacks.write_stack(rows, folder, rows_per_part=20) == 100
    return folder


def test_stack_round_trip(spark, stack):
    df = shots.read_shots(spark, stack)
    assert df.columns == ["shot", "det/area", "ipm", "n", "on"]
    got = df.orderBy("shot").collect()
    assert [(r.shot, r.n, r.ipm, r.on) for r in got] == [(i, i, i / 4, i % 2 == 0) for i in range(100)]
    assert np.array([r["det/area"] for r in got])[57, 2, 1] == 5721


def test_stack_reads_ranges_and_columns(spark, stack):
    for part in os.listdir(stack):
        os.remove(f"{stack}/{part}/ipm.npy")  # a column that nobody asks for
    df = stacks.read_stack(spark, stack, ["det/area"], range_bytes=400)
    assert df.rdd.getNumPartitions() > 10
    some = df.where("shot >= 30 and shot < 50 and shot <> 40")
    assert sorted(r.shot for r in some.collect()) == [i for i in range(30, 50) if i != 40]
    assert some.rdd.getNumPartitions() < df.rdd.getNumPartitions() / 2
    assert df.where("shot = 99").count() == 1 and df.where("shot > 200").count() == 0
    with pytest.raises(KeyError, match="ipm"):
        stacks.read_stack(spark, stack, ["ipm"])


def test_stack_ranges_are_planned_from_headers(stack):
    parts = stacks.parts_of(stack)
    assert sum(p.rows for p in parts) == 100 and max(p.rows for p in parts) <= 34
    reader = stacks.StackReader(stack, stacks.StackSource({"path": stack}).schema(), parts, 1000)
    ranges = reader.partitions()
    assert [r.first + r.start for r in ranges][0] == 0 and all(r.stop - r.start <= 1000 // 60 for r in ranges)
    got = [x for r in ranges for b in reader.read(r) for x in b.column("n").to_pylist()]
    assert got == list(range(100))


def test_stack_of_one_file_and_bad_files(spark, tmp_path):
    np.save(tmp_path / "m.npy", np.arange(12, dtype=">i2").reshape(3, 4))
    got = {(r.row, r.col): r.value for r in shots.read_mask(spark, str(tmp_path / "m.npy")).collect()}
    assert got == {(i, j): 4.0 * i + j for i in range(3) for j in range(4)}
    np.save(tmp_path / "f.npy", np.asfortranarray(np.zeros((3, 4))))
    np.save(tmp_path / "t.npy", np.array(["a"]))
    for name in "ft":
        with pytest.raises(ValueError, match="no array of numbers"):
            stacks.parts_of(str(tmp_path / f"{name}.npy"))
    (tmp_path / "u").mkdir()
    np.save(tmp_path / "u" / "a.npy", np.zeros(3))
    np.save(tmp_path / "u" / "b.npy", np.zeros(4))
    with pytest.raises(ValueError, match="differ"):
        stacks.parts_of(str(tmp_path / "u"))
    np.save(tmp_path / "e.npy", np.zeros((0, 2)))
    assert stacks.read_stack(spark, str(tmp_path / "e.npy")).count() == 0


def test_stack_of_hdf5(monkeypatch):
    """With a stand-in for h5py, which is not installed here: ranges of datasets as long as event_time."""
    sets = {"event_time": np.arange(50), "ipm5/sum": np.arange(50) / 2, "det/azav_azav": np.arange(300.0).reshape(50, 2, 3), "UserDataCfg/det/azav__azav_q": np.arange(3.0)}

    class File(dict):
        def __init__(self, path):
            super().__init__(sets)

        def visititems(self, f):
            for n, d in self.items():
                f(n, d)

        __enter__, __exit__, close = lambda s: s, lambda s, *a: None, lambda s: None

    monkeypatch.setitem(sys.modules, "h5py", types.SimpleNamespace(File=File))
    source = stacks.StackSource({"path": "x.h5", "rangeBytes": "500"})
    assert source.schema().simpleString() == "struct<shot:bigint,det/azav_azav:array<array<double>>,event_time:bigint,ipm5/sum:double>"
    reader = source.reader(source.schema())
    ranges = reader.partitions()
    got = [b for r in ranges for b in reader.read(r)]
    assert len(ranges) > 5 and [x for b in got for x in b.column("shot").to_pylist()] == list(range(50))
    assert got[-1].column("det/azav_azav").to_pylist()[-1] == sets["det/azav_azav"][-1].tolist()


def test_kinds_of_files(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.zeros(3))
    (tmp_path / "t.txt").write_text("1,2")
    (tmp_path / "h.h5").write_bytes(b"\x89HDF\r\n\x1a\n....")
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "p"))
    file = next(str(f) for f in (tmp_path / "p").iterdir() if f.name.endswith(".parquet"))
    assert [shots.sniff(str(x)) for x in (tmp_path / "a.npy", tmp_path / "t.txt", tmp_path / "h.h5", file)] == ["numpy", "text", "hdf5", "parquet"]


def test_tiff_files(spark, tmp_path):
    import struct

    df = spark.createDataFrame([(3, [[1.5, None], [2.0, 4.0]])], f"shot int, image {IMAGE}")
    assert [r.file for r in shots.write_tiffs(df, f"file://{tmp_path}").collect()] == ["3.tif"]
    data = (tmp_path / "3.tif").read_bytes()
    assert data[:4] == b"II*\0" and struct.unpack("<4f", data[8:24]) == (1.5, 0.0, 2.0, 4.0)


def test_standard_columns(spark):
    df = spark.range(1).select(F.col("id").alias("shot"), *(F.lit(v).alias(c) for c, v in (("lightStatus/xray", 1), ("lightStatus/laser", 0), ("Rayonix/pyfai_azav", 5), ("epix/ROI_0_sum", 2.0), ("a/ROI_0_area", 3), ("b/ROI_0_area", 4), ("ccm", 7.0), ("epics/ccm_E", 8.0))))
    got = shots.standard_columns(df, emission="b").first()
    assert (got.xray, got.laser, got.azav, got.xas_raw, got.roi_area, got.ccm) == (1, 0, 5, 2.0, 4, 7.0)
    assert "roi_area" not in shots.standard_columns(df).columns


# streams


def test_blocks_over_batches_and_a_restart(spark, tmp_path):
    rng = np.random.default_rng(6)
    make = lambda n: spark.createDataFrame([(int(r), int(c), float(v), int(s)) for r, c, v, s in zip(rng.integers(0, 40, n), rng.integers(0, 40, n), rng.normal(0, 5, n), rng.integers(0, 5, n), strict=True)], "row int, col int, value double, shot int").repartition(4)
    live = lambda: blocks.stream_powder_blocks(reductions.live_shots(spark, str(tmp_path / "in"), "row int, col int, value double, shot int", 2), F.col("shot"), side=8)
    for _ in range(3):
        make(400).write.mode("append").parquet(str(tmp_path / "in"))
        blocks.run_to_batches(live(), str(tmp_path / "out"), str(tmp_path / "ck"))  # each run begins from the checkpoint
        whole = spark.read.parquet(str(tmp_path / "in"))
        want = {(r.kind, r.row, r.col): r.value for r in images.powder_max(whole, F.col("shot")).collect()}
        got = {(r.kind, r.row, r.col): r.value for r in blocks.powder_of_batches(spark, str(tmp_path / "out")).collect()}
        assert got == want
    before = len(list((tmp_path / "out").iterdir()))
    spark.createDataFrame([(3, 3, 1e6, 4), (3, 4, float("nan"), 4)], "row int, col int, value double, shot int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    blocks.run_to_batches(live(), str(tmp_path / "out"), str(tmp_path / "ck"))
    last = sorted((tmp_path / "out").iterdir())[before:]
    assert spark.read.parquet(str(last[0])).count() == 1  # only the block that changed leaves the batch


def test_progress_is_reported(spark, tmp_path):
    assert blocks.steps_passed(0, 9) == [] and blocks.steps_passed(0, 35) == [30] and blocks.steps_passed(95, 130) == [100]
    assert blocks.steps_passed(0, 2500) == [100, 1000, 2000] and blocks.steps_passed(1000, 1999) == []
    said = []
    reporter = blocks.ProgressReporter("progress", lambda step, events, hits: said.append((step, events, hits)))
    spark.streams.addListener(reporter)
    try:
        for k, n in enumerate((25, 25, 60, 900, 40)):
            spark.range(n).select((F.col("id") % 5 == 0).alias("hit")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            df = reductions.counted(reductions.live_shots(spark, str(tmp_path / "in"), "hit boolean", 1), "progress", F.col("hit"))
            df.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
            for _ in range(100):
                if reporter.events >= sum((25, 25, 60, 900, 40)[: k + 1]):
                    break
                import time

                time.sleep(0.1)
    finally:
        spark.streams.removeListener(reporter)
    assert said == [(20, 25, 5), (50, 50, 10), (100, 110, 22), (1000, 1010, 202)]


def test_producer_writes_events_sums_and_config(spark, tmp_path):
    rng = np.random.default_rng(8)
    said, whole = [], []
    for k in range(2):
        rows = [(100 * k + i, bool(rng.random() < 0.3), rng.normal(0, 5, (3, 4)).tolist()) for i in range(30)] + [(100 * k + 90, False, None)]
        whole += rows
        spark.createDataFrame(rows, f"shot int, off boolean, image {IMAGE}").repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        live = reductions.live_shots(spark, str(tmp_path / "in"), f"shot int, off boolean, image {IMAGE}", 1)
        steps = [lambda s: s.withColumn("top", F.array_max(F.flatten("image"))), lambda s: s.withColumn("twice", 2 * F.col("top"))]
        producer.run_producer(live, steps, str(tmp_path / "out"), str(tmp_path / "ck"), {"run": k}, F.col("off"))
    events = {r.shot: r for r in producer.events_of(spark, str(tmp_path / "out")).collect()}
    assert len(events) == len(whole) == 62 and "image" not in events[0].asDict()
    for shot, _, m in whole:
        assert events[shot].twice == (pytest.approx(2 * np.max(m)) if m else None)
    got = {(r.row, r.col): r for r in producer.sums_of(spark, str(tmp_path / "out")).collect()}
    m, off = np.array([r[2] for r in whole if r[2]]), np.array([r[1] for r in whole if r[2]])
    for i in range(3):
        for j in range(4):
            r = got[i, j]
            assert (r.calib, r.calib_dropped, r.calib_dropped_square) == pytest.approx((m[:, i, j].sum(), m[off, i, j].sum(), (m[off, i, j] ** 2).sum()))
    assert producer.config_of(spark, str(tmp_path / "out")) == {"run": 0} and not said  # of the first batch alone


def test_first_batch_is_saved_once(spark):
    saved, seen = [], []
    batch = reductions.once_first(lambda df: saved.append(df.count()), lambda df, n: seen.append(n))
    for n in range(3):
        batch(spark.range(n + 1), n)
    assert saved == [1] and seen == [0, 1, 2]


# droplets


def flood(mask):
    label, n = np.zeros(mask.shape, int), 0
    for r, c in zip(*np.nonzero(mask), strict=True):
        if label[r, c]:
            continue
        n, todo = n + 1, [(r, c)]
        label[r, c] = n
        while todo:
            a, b = todo.pop()
            for y, x in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)):
                if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not label[y, x]:
                    label[y, x] = n
                    todo.append((y, x))
    return label, n


@pytest.mark.parametrize("share", [0.0, 0.1, 0.4, 0.6, 0.9, 1.0])
def test_labels_equal_a_flood_fill(share):
    mask = np.random.default_rng(3).random((7, 13, 17)) < share
    runs = droplets.labelled_runs(mask)
    at, group = droplets._pixels(runs)
    label = np.zeros(mask.size, int)
    label[at] = group + 1
    off = 0
    for k, m in enumerate(label.reshape(mask.shape)):
        want, n = flood(mask[k])
        assert np.array_equal(m, np.where(want > 0, want + off, 0))
        off += n
    assert runs.groups == off


def test_a_winding_droplet_is_one():
    spiral = np.zeros((1, 41, 41), bool)
    for k in range(0, 41, 4):  # combs that meet at one end
        spiral[0, k, :], spiral[0, k : k + 3, (40 if k % 8 == 0 else 0)] = True, True
    spiral[0, :, 20] = True
    assert droplets.labelled_runs(spiral).groups == flood(spiral[0])[1]


def test_droplets_and_photons(spark):
    rng = np.random.default_rng(4)
    made = [np.where(rng.random((9, 11)) < 0.3, rng.uniform(5, 40, (9, 11)), 0.0) for _ in range(40)]
    rows = [(i, m.tolist()) for i, m in enumerate(made)] + [(100, None), (101, []), (102, np.zeros((4, 4)).tolist()), (103, np.full((3, 5), 50.0).tolist())]
    df = spark.createDataFrame(rows, f"shot int, image {IMAGE}").repartition(3)
    found = {r.shot: r.droplets for r in droplets.droplets(df, threshold=20.0, low=5.0, min_adu=40.0).collect()}
    placed = {r.shot: r.photon_places for r in droplets.placed_photons(df, per_photon=15.0, threshold=20.0, low=5.0, min_adu=40.0).collect()}
    assert found[100] is None and found[101] is None and found[102] == [] and placed[102] == []
    for i, m in enumerate(made):
        label, n = flood(m > 5)
        want, photons = [], {}
        for k in range(1, n + 1):
            r, c = np.nonzero(label == k)
            v = m[r, c]
            if v.max() > 20 and v.sum() >= 40:
                want.append((len(v), pytest.approx(v.sum()), pytest.approx((r * v).sum() / v.sum()), pytest.approx((c * v).sum() / v.sum())))
                left, number = v / 15.0, np.zeros(len(v), int)
                for _ in range(int(np.round(v.sum() / 15.0))):  # one photon after the other, where most is left
                    at = int(np.floor(left).argmax()) if left.max() >= 1 else int(left.argmax())
                    number[at] += 1
                    left[at] -= 1
                photons |= {(a, b): x for a, b, x in zip(r.tolist(), c.tolist(), number.tolist(), strict=True) if x}
        assert [tuple(d) for d in found[i]] == want
        assert {(p.row, p.col): p.photons for p in placed[i]} == photons


def test_droplets_of_large_images_are_fast():
    import time

    rng = np.random.default_rng(0)
    m = np.where(rng.random((20, 512, 512)) < 0.02, rng.random((20, 512, 512)) * 100, 0.0)
    begun = time.perf_counter()
    droplets.droplets_of(m, 5.0, 5.0, 60.0)
    fast = time.perf_counter() - begun
    begun = time.perf_counter()
    label, n = flood(m[0] > 5)
    for k in range(1, min(n, 400) + 1):  # a pass over the image for each droplet
        m[0][label == k].sum()
    assert fast < (time.perf_counter() - begun) * n / min(n, 400) * 20 / 20


# peaks


def brute_peaks(y, prominence, distance, height):
    keep = []
    for i in sorted((i for i in range(1, len(y) - 1) if y[i - 1] < y[i] > y[i + 1] and y[i] >= height), key=lambda i: (-y[i], -i)):
        if all(abs(i - j) >= distance for j in keep):
            keep.append(i)
    out = []
    for i in sorted(keep):
        a, b = i, i
        while a > 0 and y[a - 1] <= y[i]:
            a -= 1
        while b < len(y) - 1 and y[b + 1] <= y[i]:
            b += 1
        rise = y[i] - max(y[a : i + 1].min(), y[i : b + 1].min())
        if rise >= prominence:
            out.append((i, pytest.approx(rise)))
    return out


def test_peaks_of_many_profiles(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 3, int(rng.choice([3, 30, 70]))).cumsum().tolist()) for i in range(60)] + [(60, None), (61, []), (62, [1.0]), (63, np.arange(20.0).tolist())]
    df = spark.createDataFrame(rows, "shot int, p array<double>").repartition(3)
    for prominence, distance in ((0.0, 1), (2.0, 4), (5.0, 10)):
        got = {}
        for r in peaks.profile_peaks(df, ["shot"], "p", prominence, distance, -5.0).collect():
            got.setdefault(r.shot, []).append((r.place, r.prominence))
        for i, y in rows:
            assert sorted(got.get(i, [])) == (brute_peaks(np.array(y), prominence, distance, -5.0) if y else [])


def plain_peaks(panel, npix_min, npix_max, amax_thr, atot_thr, son_min, rank, r0, dr, nsigm):
    """The finder pixel by pixel."""
    h, w = panel.shape
    out = []
    for r in range(h):
        for c in range(w):
            a, b, d, e = max(0, r - rank), min(h, r + rank + 1), max(0, c - rank), min(w, c + rank + 1)
            box = panel[a:b, d:e]
            if panel[r, c] <= amax_thr or panel[r, c] < box.max() or (box == panel[r, c]).ravel().argmax() != (r - a) * (e - d) + c - d:
                continue
            ring = [panel[y, x] for y in range(h) for x in range(w) if r0 <= np.hypot(y - r, x - c) <= r0 + dr]
            base, noise = (np.mean(ring), np.std(ring)) if ring else (0.0, 0.0)
            label, _ = flood(box - base > nsigm * noise)
            member = label == label[r - a, c - d] if label[r - a, c - d] else np.zeros(box.shape, bool)
            member[r - a, c - d] = True
            n, total, top = member.sum(), (box - base)[member].sum(), panel[r, c] - base
            son = total / (noise * np.sqrt(n)) if noise > 0 else np.inf
            if npix_min <= n <= npix_max and top >= amax_thr and total >= atot_thr and son >= son_min:
                y, x = np.nonzero(member)
                out.append((r, c, n, top, total, ((y + a) * (box - base)[member]).sum() / total, y.min() + a, y.max() + a, x.min() + d, x.max() + d, son))
    return out


def test_peak_finder_equals_a_plain_one(spark):
    rng = np.random.default_rng(3)
    made = []
    for k in range(12):
        m = rng.normal(0, 1, (2, 18, 21))
        m = np.round(m * 2) if k % 3 == 0 else m
        for _ in range(12):
            m[rng.integers(2), rng.integers(18), rng.integers(21)] += rng.integers(5, 60)
        made.append(m)
    for rank, r0, dr in ((1, 2.0, 1.5), (3, 3.0, 2.0)):
        settings = dict(npix_min=1, npix_max=30, amax_thr=3.0, atot_thr=4.0, son_min=1.0, rank=rank, r0=r0, dr=dr, nsigm=1.0)
        df = spark.createDataFrame([(i, m.tolist()) for i, m in enumerate(made)] + [(50, None), (51, [])], "shot int, image array<array<array<double>>>").repartition(3)
        got = {r.shot: r.peaks for r in peaks.find_peaks(df, **settings).collect()}
        assert got[50] == got[51] == []
        for i, m in enumerate(made):
            want = [(s, *(pytest.approx(float(v)) for v in p)) for s in range(2) for p in plain_peaks(m[s], **settings)]
            assert [(p.seg, p.row, p.col, p.npix, p.amax, p.atot, p.rcent, p.rmin, p.rmax, p.cmin, p.cmax, p.son) for p in got[i]] == want


# splines and filters


def test_widths_by_roots():
    x = np.linspace(-4, 4, 41)
    bell = np.exp(-(x**2) / 2)
    assert len(splines.spline_roots(x, bell - 0.5)) == 2
    assert numeric.fwhm(x, bell) == pytest.approx(2.354820, abs=2e-4)
    assert numeric.fwhm(x, bell, np.arange(41.0)) == pytest.approx(2.354820 / 0.2, abs=2e-3)
    two = np.exp(-((x - 2) ** 2) * 4) + np.exp(-((x + 2) ** 2) * 4)  # four roots: a gaussian is fitted
    assert len(splines.spline_roots(x, two - two.max() / 2)) == 4
    assert numeric.fwhm(x, two) == pytest.approx(numeric.fit_gaussian(x, two)["sigma"] * 2.3548200, rel=1e-6)
    flat = np.full(41, 3.0) + bell * 0.1  # none
    assert len(splines.spline_roots(x, flat - flat.max() / 2)) == 0
    assert numeric.fwhm(x, flat) == pytest.approx(2.354820, rel=1e-3)
    cubic = (x - 1.3) * (x + 2.1) * (x - 3.3)  # one cubic through all points
    assert splines.spline_roots(x, cubic) == pytest.approx([-2.1, 1.3, 3.3])
    assert np.isnan(numeric.fwhm(np.empty(0), np.empty(0)))


def test_rotation_by_splines(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(3, 9, 14))
    for k in range(-1, 5):
        assert np.allclose(splines.rotated_images(m, 90 * k), np.stack([np.rot90(x, k) for x in m]), atol=1e-9)

    def direct(n):  # coefficients by solving for them
        a = np.zeros((n, n))
        for i in range(n):
            for d, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
                j = abs(i + d)
                a[i, j if j < n else 2 * n - 2 - j] += w
        return np.linalg.inv(a)

    c = np.einsum("ij,njk,lk->nil", direct(9), m, direct(14))
    assert np.abs(splines.spline_coefficients(m) - c).max() < 1e-10
    basis = lambda t: np.where(np.abs(t) < 1, 2 / 3 - t**2 + np.abs(t) ** 3 / 2, np.where(np.abs(t) < 2, (2 - np.abs(t)) ** 3 / 6, 0.0))
    angle = 31.0
    turned = splines.rotated_images(m, angle, whole=False)
    co, si = np.cos(np.deg2rad(angle)), np.sin(np.deg2rad(angle))
    for y, x in ((4, 7), (3, 5), (6, 8), (0, 0)):
        sy, sx = co * (y - 4) + si * (x - 6.5) + 4, -si * (y - 4) + co * (x - 6.5) + 6.5
        want = np.zeros(3)
        if 0 <= sy <= 8 and 0 <= sx <= 13:
            for i in range(-3, 12):
                for j in range(-3, 17):
                    ii, jj = abs(i) if abs(i) < 9 else 16 - abs(i), abs(j) if abs(j) < 14 else 26 - abs(j)
                    want += c[:, ii, jj] * basis(sy - i) * basis(sx - j)
        assert turned[:, y, x] == pytest.approx(want, abs=1e-9)
    df = spark.createDataFrame([(0, m[0].tolist()), (1, None)], f"shot int, image {IMAGE}")
    got = {r.shot: r.image for r in images.rotated(df, 45.0).collect()}
    assert got[1] is None and np.allclose(got[0], splines.rotated_images(m[:1], 45.0)[0])


def test_butterworth_sections(spark):
    known = splines.butterworth(2, 0.25)[0]
    assert known == pytest.approx([0.09763107, 0.19526215, 0.09763107, 1.0, -0.94280904, 0.33333333], abs=1e-8)
    f = np.linspace(0, 0.99, 50)
    z = np.exp(-1j * np.pi * f)
    for order in range(1, 7):
        h = np.prod([(b0 + b1 * z + b2 * z * z) / (1 + a1 * z + a2 * z * z) for b0, b1, b2, _, a1, a2 in splines.butterworth(order, 0.3)], axis=0)
        assert np.abs(h) == pytest.approx(1 / np.sqrt(1 + (np.tan(np.pi * f / 2) / np.tan(np.pi * 0.15)) ** (2 * order)))
    y = np.random.default_rng(1).normal(size=80)
    b, a = splines.butterworth(2, 0.25)[0, :3], splines.butterworth(2, 0.25)[0, 3:]

    def once(x):  # the recursion, begun as if the first value had always been there
        out = np.zeros(len(x))
        for i in range(len(x)):
            past = lambda v, k: v[i - k] if i >= k else x[0]  # noqa: B023, E731
            out[i] = b[0] * x[i] + b[1] * past(x, 1) + b[2] * past(x, 2) - a[1] * past(out, 1) - a[2] * past(out, 2)
        return out

    wide = np.concatenate((2 * y[0] - y[9:0:-1], y, 2 * y[-1] - y[-2:-11:-1]))
    want = once(once(wide)[::-1])[::-1][9:-9]
    assert splines.smoothed(y[None])[0] == pytest.approx(want)
    assert splines.smoothed(np.full((2, 5), 7.0), 4) == pytest.approx(np.full((2, 5), 7.0))
    profile = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(y)], "k string, r int, value double")
    got = {r.r: r.value for r in images.smoothed_profile(profile, ["k"], floor=-1e9).collect()}
    assert [got[i] for i in range(80)] == pytest.approx(want)


# lossy images


def test_lossy_round_trip_keeps_regions(spark):
    rng = np.random.default_rng(5)
    panels = rng.normal(0, 50, (2, 13, 17))
    panels[0, 3, 4] = np.nan
    mask = (rng.random((2, 13, 17)) < 0.9).astype(int)
    peaks_ = [(0, 2, 2), (1, 12, 16), (1, 6, 8)]
    df = spark.createDataFrame([(0, panels.tolist(), peaks_), (1, None, None), (2, panels.tolist(), [])], "shot int, image array<array<array<double>>>, peaks array<struct<seg: int, row: int, col: int>>")
    got = {r.shot: r for r in images.lossy_round_trip(df, abs_error=4.0, window=5, bin_size=3, mask=mask.tolist()).collect()}
    out = np.array(got[0].image)
    inside = np.zeros(panels.shape, bool)
    for s, r, c in peaks_:
        inside[s, max(0, r - 2) : r + 3, max(0, c - 2) : c + 3] = True
    number = ~np.isnan(panels)
    assert np.abs(out - panels)[inside & number].max() <= 4.0 + 1e-9 and np.isnan(out[0, 3, 4])
    for s in range(2):
        for r in range(13):
            for c in range(17):
                if not inside[s, r, c] and number[s, r, c]:
                    box = np.s_[s, r // 3 * 3 : r // 3 * 3 + 3, c // 3 * 3 : c // 3 * 3 + 3]
                    use = (~inside & number & (mask == 1))[box]
                    mean = panels[box][use].mean() if use.any() else 0.0
                    assert out[s, r, c] == pytest.approx(np.round(mean / 8.0) * 8.0 if mask[s, r, c] else 0.0)
    assert got[0].bytes_raw == 4 * panels.size and 0 < got[2].bytes_kept < got[0].bytes_kept < got[0].bytes_raw
    assert got[1].image is None and got[1].bytes_kept == 0


# geometry files


def test_geometry_file_panels(spark):
    lines = ["; made by hand", "clen = 0.1", "res = 9090.9", "coffset = 0.58 ; metres", "p0/min_fs = 0", "p0/max_fs = 1", "p0/min_ss = 0", "p0/max_ss = 0", "p0/corner_x = -10.5", "p0/corner_y = 3", "p0/fs = x", "p0/ss = -0.5x+0.75y", "p1/min_fs = 2", "p1/max_fs = 2", "p1/min_ss = 1", "p1/max_ss = 2", "p1/corner_x = 0", "p1/corner_y = 0", "p1/fs = -y", "p1/ss = 1e-1x", "p1/res = 5000", "bad0/min_fs = 4", "rigid_group_a = p0,p1"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.panel: r for r in geomfile.panels(df).collect()}
    assert set(got) == {"p0", "p1"} and (got["p0"].res, got["p1"].res, got["p1"].coffset) == (9090.9, 5000.0, 0.58)
    assert tuple(got["p0"].fs) == (1.0, 0.0) and tuple(got["p0"].ss) == (-0.5, 0.75) and tuple(got["p1"].fs) == (0.0, -1.0) and tuple(got["p1"].ss) == (0.1, 0.0)
    places = {(r.panel, r.fs, r.ss): (r.x, r.y) for r in geomfile.pixel_places(geomfile.panels(df)).collect()}
    assert places["p0", 1, 0] == (-9.5, 3.0) and places["p1", 2, 2] == (0.1, 0.0) and len(places) == 4
    name = spark.createDataFrame([("MFXEndstation.0:Epix10ka2M.0",), ("Jungfrau4M of cxi",)], "n string")
    assert [r[0] for r in name.select(geomfile.camera_length_of(F.col("n"))).collect()] == ["MFX:ROB:CONT:POS:Z", "CXI:DS1:MMS:06.RBV"]
    with pytest.raises(Exception, match="no camera length"):
        spark.createDataFrame([("other",)], "n string").select(geomfile.camera_length_of(F.col("n"))).collect()
    assert spark.range(1).select(geomfile.camera_offset(F.lit(100.0), F.lit(40.0))).first()[0] == pytest.approx(0.06)


def test_panels_do_not_sort_lines(spark):
    """Sorted lines are all lines of a task in memory."""
    df = spark.createDataFrame([(1, "p0/fs = x"), (1, "res = 2")], "file long, line string")
    for rows in (geomfile.panels(df, keep=("file",)), geomfile.panels(df)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("parts", [1, 3])
def test_repeated_lines_of_panels(spark, parts):
    """Both parts of an axis are of one line, whichever counts; results do not depend on partitions; odd panels have a row."""
    axes = ["+1.0x -2.0y", "3y", "-7x+3y", "9x", "x+3y"]
    lines = [(f, f"p{i}/{k} = {v}") for f in range(3) for i in range(20) for k in ("fs", "ss") for v in axes] + [(0, "p0/min_fs = 9"), (0, "p0/min_fs = 1e1"), (1, "min_fs = 4"), (1, "ss = 2y"), (1, "q/fs = y"), (2, "q/note = text"), (2, "note = text"), (2, "bad0/min_fs = text")]
    got = {(r.file, r.panel): r for r in geomfile.panels(spark.createDataFrame(lines, "file long, line string").repartition(parts), keep=("file",)).collect()}
    allowed = {(1.0, -2.0), (0.0, 3.0), (-7.0, 3.0), (9.0, 0.0), (1.0, 3.0)}
    assert len(got) == 62 and all({tuple(r.fs), tuple(r.ss)} <= allowed for (_, panel), r in got.items() if panel != "q")
    assert len({(tuple(r.fs), tuple(r.ss)) for (_, panel), r in got.items() if panel != "q"}) == 1
    assert got[0, "p0"].min_fs in (9, 10) and got[0, "p1"].min_fs is None and got[1, "p5"].min_fs == 4 and got[1, "p5"].res is None
    assert tuple(got[1, "q"].fs) == (0.0, 1.0) and tuple(got[1, "q"].ss) == (0.0, 2.0) and tuple(got[2, "q"].fs) == tuple(got[2, "q"].ss) == (0.0, 0.0)


def test_geometry_lines_are_dealt_out(spark, tmp_path):
    """Rows of one row group become lines in more than one task."""
    part = spark.range(0, 20000, 1, 1).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size"), (F.col("id") / 7).alias("p_retailprice"))
    part.write.parquet(str(tmp_path / "part.parquet"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "8k")
    try:
        lines = geomfile.geometry_lines(catalog_kernels.geometry_panels(spark, str(tmp_path)), keep=("file",))
        most = max(r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", before)
    assert lines.count() == 200000 and most < 100000
