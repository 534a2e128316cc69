"""What larger tables brought to light: keys without points in an event, ties, zeros, and steps that grew too fast."""

import math

import numpy as np
from pyspark.sql import functions as F

from orrery.operators import boxes, kernels, matching, medians, series, survey, timing
from orrery.plans import catalog

SERIES = "k long, t double, flux double, period double, t0 double, duration double"


def test_robust_depth_of_a_key_without_points_in_its_event(spark):
    rows = [(1, 0.3 + i / 100, 1.0 + 0.01 * (i % 5), 1.0, 0.0, 0.1) for i in range(20)]
    got = series.robust_depth(spark.createDataFrame(rows, SERIES), ["k"]).collect()
    assert [(r.n_in, r.n_out, r.depth, r.sigma, r.mismatch) for r in got] == [(0, 20, None, None, True)]


def test_fold_test_counts_equal_sets_whatever_their_order(spark):
    # two shifts hold the same fluxes in opposite orders, whose sums differ in the last bits
    for first in ([0.1, 0.2, 0.3, 0.7], [0.7, 0.3, 0.2, 0.1]):
        rows = [(1, i + 0.01, f, 1.0, 0.0, 0.2, 1.0) for i, f in enumerate(first)] + [(1, i + 0.51, f, 1.0, 0.0, 0.2, 1.0) for i, f in enumerate(reversed(first))]
        rows += [(1, i + 0.3, 1.0, 1.0, 0.0, 0.2, 1.0) for i in range(3)]
        df = spark.createDataFrame(rows, SERIES + ", flux_err double").coalesce(1)
        assert [r.p_value for r in kernels.fold_test(df, ["k"], 2).collect()] == [1.0]


def test_relative_flux_counts_zeros_in_the_median(spark, tmp_path):
    rows = [(i, 1, "view", v, "{}") for i, v in enumerate([9.0, 0.0, 2.0, 4.0, 0.0, 8.0, 16.0, 9.0], 0)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").withColumn("ts", F.lit("2024-01-02").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.flux for r in catalog.queries()["relative_flux"](spark, str(tmp_path)).collect()}
    # of the values at ids 1 to 6, 3 is the median in flux, as logarithms between 2 and 4
    assert got[1] == got[4] == 0.0 and 2 in got
    assert got[2] == round(10 ** (-0.4 * 0.5 * math.log(4 / 2)), 6)


def test_bounded_box_search_equals_the_whole_one():
    rng = np.random.default_rng(3)
    durations, width = np.geomspace(0.02, 0.5, 5), 0.002
    for n, values in ((60, 1), (25, 3)):
        at = np.sort(rng.choice(15_000, n, replace=False))
        w = rng.choice([400.0, 800.0], n, p=[0.9, 0.1])
        wy = w * rng.exponential(1.4, (values, n))
        grids = [np.geomspace(0.65, 12, 400) * (1 + i / 50) for i in range(values)]
        got = boxes.best_of_scans(at, w, wy if values > 1 else wy[0], width, grids, durations)
        for g, y, found in zip(grids, wy, got):
            snr, which, first, depth = boxes.best_boxes(at, w, y, width, g, durations)
            i = int(np.argmax(snr))
            assert found == (snr[i], i, which[i], first[i], depth[i])
            assert (boxes.box_bounds(at, w, y, width, g, durations) * (1 + boxes.BOUND_SLACK) >= snr).all()


def test_dense_box_search_equals_the_sorted_one():
    rng = np.random.default_rng(4)
    at = np.flatnonzero(rng.random(8_000) < 0.8)
    w = rng.uniform(300, 900, len(at))
    args = at, w, w * rng.normal(1, 0.3, len(at)), 0.002, np.geomspace(0.7, 7, 6), np.array([0.02, 0.1, 0.4])
    dense = boxes.best_boxes(*args)
    single = [boxes._dense_box((at + 0.5) * 0.002, w, args[2] - w * (args[2].sum() / w.sum()), w.sum(), 0.002, p, np.rint(args[5] / 0.002).astype(int), args[5]) for p in args[4]]
    assert [tuple(x) for x in zip(*dense)] == single


def test_dense_search_by_bounds_equals_the_whole_one(monkeypatch):
    rng = np.random.default_rng(5)
    durations, width, measured = np.geomspace(0.02, 0.5, 10), 0.002, []
    best_boxes = boxes.best_boxes
    for share in (0.15, 0.97):
        at = 9_860_000 + np.flatnonzero(rng.random(15_000) < share)
        w = rng.choice([1e4, 3e4], len(at))
        for depth in (0.0, 0.02):
            wy = w * (1 + rng.normal(0, 0.05, len(at)) - depth * (np.mod((at + 0.5) * width, 2.3) < 0.3))
            periods = np.geomspace(0.65, 14.9, 150)
            snr, which, first, deep = best_boxes(at, w, wy, width, periods, durations)
            assert (boxes.dense_bounds(at, w, wy, width, periods, durations) >= snr).all()
            i = int(np.argmax(snr))
            monkeypatch.setattr(boxes, "best_boxes", lambda *a: measured.append(len(a[4])) or best_boxes(*a))
            assert boxes.best_of_scans(at, w, wy, width, [periods], durations) == [(snr[i], i, which[i], first[i], deep[i])]
            monkeypatch.undo()
    assert sum(measured) < 150  # of 600 periods


def test_bounds_leave_out_runs_that_cannot_reach_the_best():
    rng = np.random.default_rng(8)
    at = 9_860_000 + np.sort(rng.choice(15_000, 70, replace=False))
    w = np.full(70, 400.0)
    args = at, w, w * rng.exponential(1.4, 70), 0.002, np.geomspace(0.65, 14.9, 900), np.geomspace(0.02, 0.5, 10)
    snr = boxes.best_boxes(*args)[0]
    for floor in (0.0, 0.8 * snr.max(), float(snr.max())):
        bound = boxes.box_bounds(*args, floor) * (1 + boxes.BOUND_SLACK)
        assert (bound >= snr)[snr >= floor].all()
    assert (bound < floor).sum() > 600  # long periods have no run of so many points
    (found,) = boxes.best_of_scans(*args[:4], [args[4]], args[5])
    assert found[:2] == (snr.max(), int(np.argmax(snr)))


def test_classifiers_read_equal_rows_once(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(survey, "written", lambda df, tag, real=survey.written: tables.append(real(df, tag)) or tables[-1])
    rows = [(i, int(i % 4 < 2), None if i % 50 == 7 else float(i % 4) + 0.1, "ab"[i % 2]) for i in range(600)]
    df = spark.createDataFrame(rows, "key long, y int, x double, c string").repartition(3)
    got = survey.cross_validated(df, "key", "y", ["x"], ["c"], folds=2).collect()
    assert sorted((r.model, r.fold) for r in got) == [(m, f) for m in ("boosted", "logistic") for f in (0, 1)]
    assert all(r.auc > 0.95 for r in got)
    (held,) = tables
    assert held.count() <= 12 and held.agg(F.sum("__times")).first()[0] == 600


def test_no_window_runs_to_the_end_of_its_key_from_each_row(spark):
    """Such a frame is gone through anew for each row: quadratic in a key's points."""
    at = [0.0, 0.1, 0.2, 0.2, 1.0, 1.0, 1.1, 2.5, 2.6, 2.9, 2.9, 3.0, 3.05]
    df = spark.createDataFrame([(k, t, 1.0, 1.0, 0.0, 0.3) for k in (1, 2) for t in at], SERIES)
    found = series.coverage(df, ["k"], gap=0.5, near=0.15)
    filled = series.filled(df.withColumn("flux", F.when(F.col("t") % 1 != 0, F.col("t"))), ["k"], "flux")
    for x in (found, filled):
        assert "currentrow$(), unboundedfollowing$()" not in x._jdf.queryExecution().toString()
    edge = [a for a, b in zip(at, at[1:]) if b - a > 0.5] + [b for a, b in zip(at, at[1:]) if b - a > 0.5]
    close = sum(any(abs(t - e) < 0.15 for e in edge) for t in at)
    assert {r.share_near_gap for r in found.collect()} == {close / len(at)}
    got = {r.t: r.flux for r in filled.filter("k = 1").collect()}
    assert got[0.0] == 0.1 and abs(got[1.0] - 1.0) < 1e-12 and got[3.05] == 3.05 and abs(got[3.0] - 3.0) < 1e-12


def test_counted_quantile_is_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(k, float(x), int(n)) for k, size in (("a", 300), ("b", 1), ("c", 7)) for x, n in zip(rng.permutation(size) / 7, rng.integers(1, 9, size))]
    got = {r.k: r.value for r in survey.counted_quantile(spark.createDataFrame(rows, "k string, x double, n long").repartition(3), "k", "x", "n", 0.6827, 20).collect()}
    for k in "abc":
        values = np.repeat([x for g, x, _ in rows if g == k], [n for g, _, n in rows if g == k])
        assert abs(got[k] - np.quantile(values, 0.6827)) < 1e-12


def test_season_points_carry_no_templates(spark):
    t = np.arange(0, 60, 0.05)
    rows = [("a", int(x // 10), float(x), float(1 - 0.2 * (abs((x - 1) % 3 - 0.02) < 0.3)), 3.0, 1.0, 0.6) for x in t]
    df = spark.createDataFrame(rows, "k string, s long, t double, flux double, period double, t0 double, duration double")
    found = timing.season_times(df, timing.templates(df, "k"), "k", "s", replicates=3, least=10, least_in=3)
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan and len(found.collect()) > 0


def sky_rows(spark, n, seed, names):
    rng = np.random.default_rng(seed)
    rows = [(i, float(350 + 20 * a) % 360, float(b), float(c)) for i, (a, b, c) in enumerate(zip(rng.uniform(size=n), 87 + rng.normal(0, 0.7, n), rng.normal(10, 0.4, n)))]
    rows += [(n + i, *rows[i][1:]) for i in range(20)] + [(n + 20, None, 1.0, 1.0)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(names, ("long", "double", "double", "double")))).filter(f"coalesce({names[2]}, 0) < 90")


def test_matches_through_growing_radii_equal_those_of_the_whole(spark, monkeypatch):
    left, right = sky_rows(spark, 150, 1, ("id", "ra", "dec", "mag")), sky_rows(spark, 400, 2, ("id2", "ra2", "dec2", "mag2"))
    left = left.unionByName(spark.createDataFrame([(999, 1.0, 88.0, None)], left.schema))
    near = lambda: sorted(map(tuple, matching.nearest(left.select("id", "ra", "dec"), right.select("id2", "ra2", "dec2"), 9000.0, "id", "id2").select("id", "id2").collect()))
    scored = lambda: sorted(map(tuple, matching.scored_match(left, right, 9000.0, "id", "mag", "mag2", tie="id2").select("id", "id2", "quality").collect()))
    tried, within = [], matching.within

    def counted(a, b, radius, *args, **more):
        out = within(a, b, radius, *args, **more)
        tried.append(out.count())
        return out

    monkeypatch.setattr(matching, "within", counted)
    found = []
    for shares in ([1.0], [0.125, 0.25, 0.5, 1.0]):
        monkeypatch.setattr(matching, "_shares", lambda _, s=shares: s)
        tried.clear()
        found.append((near(), sum(tried)))
        found.append((scored(), None))
    assert found[0][0] == found[2][0] and found[1][0] == found[3][0] and found[0][0] and found[1][0]
    assert found[2][1] < found[0][1] / 2  # fewer pairs are looked at


def test_orbits_are_solved_once_for_equal_arguments(spark, data):
    plan = catalog.queries()["orbit_scalars"](spark, data)._jdf.queryExecution().toString()
    assert "orbits-" in plan and "lambdafunction" not in plan


def test_event_times_of_a_large_object_are_summed_over_parts(spark):
    rng = np.random.default_rng(5)
    t = np.sort(rng.uniform(0, 12, 3000))
    rows = [(k, float(x), float(1.0 - 0.2 * (abs((x - 0.5 + 1.5) % 3 - 1.5) < 0.2) + e), 3.0, 0.5, 0.4) for k, far in ((1, 99), (2, 3)) for x, e in zip(t, rng.normal(0, 0.01, 3000)) if x < far]
    df = spark.createDataFrame(rows, SERIES).withColumn("flux_err", F.lit(0.01))
    times = lambda most: {(r.k, r.epoch): r for r in kernels.event_times(df, "k", max_points=most).collect()}
    whole, parts = times(100_000), times(150)
    assert whole.keys() == parts.keys() and len(whole) >= 5
    for i, r in whole.items():
        assert all(math.isclose(r[c], parts[i][c], rel_tol=1e-9) for c in ("time", "time_err", "amplitude", "gain"))


def test_box_medians_over_chunks_equal_those_of_masks(spark):
    rng = np.random.default_rng(6)
    half, centres = 0.03, [0.0, 0.011, 0.4, 0.97]
    phase = np.round(rng.random(4000), 3)  # many on an edge
    flux = np.round(rng.exponential(1.0, 4000), 2)
    points = spark.createDataFrame([(1, float(p), float(f)) for p, f in zip(phase, flux)], "k long, phase double, flux double")
    boxes = spark.createDataFrame([(1, half, centres)], "k long, half double, centres array<double>")
    got = {r.centre: r for r in medians.box_medians(points, ["k"], boxes, (1.2, 3.0), 10, 10, chunk=500).collect()}
    assert sorted(got) == centres
    for c, r in got.items():
        apart = np.abs(np.mod(phase - c + 0.5, 1.0) - 0.5)
        inside, side = flux[apart / half <= 1], flux[(apart / half > 1.2) & (apart < 3.0 * half) & (apart / half < 3.0)]
        assert (r.n_in, r.n_side, r.low, r.base, r.own) == (len(inside), len(side), np.median(inside), np.median(side), np.median(np.abs(inside - np.median(inside))))


def test_medians_inside_and_outside_by_ranks():
    rng = np.random.default_rng(7)
    for n, k in ((6, 5), (7, 5), (400, 180), (401, 7)):
        values = np.sort(np.round(rng.normal(0, 1, n), 1))
        for ranks in (rng.choice(n, k, replace=False), np.arange(n - k, n), np.arange(k)):
            assert timing.median_apart(ranks, values) == (np.median(values[ranks]), np.median(np.delete(values, ranks)))
