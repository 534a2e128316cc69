"""Box searches and local scans against plain loops over every period, duration and box."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import boxes
from orrery.plans import catalog


def plain_boxes(at, w, wy, width, periods, durations):
    """(snr, period, duration, depth) of the best box that begins in a phase bin with a point, by masks."""
    best, total, everything = (-np.inf,), w.sum(), wy.sum()
    for p in periods:
        turn = int(np.ceil(p / width))
        folded = np.minimum(np.floor(np.mod((at + 0.5) * width, p) / width), turn - 1)
        begins = np.unique(folded)
        ahead = np.mod(folded[None, :] - begins[:, None], turn)
        for d in durations:
            span = int(np.rint(d / width))
            if d >= p or span < 1 or span >= turn:
                continue
            inside = ahead < span
            iw, iy = inside @ w, inside @ wy
            ok = (total - iw > 1e-9 * total) & (iw > 0)
            if not ok.any():
                continue
            depth = (everything - iy[ok]) / (total - iw[ok]) - iy[ok] / iw[ok]
            snr = depth / np.sqrt(1 / iw[ok] + 1 / (total - iw[ok]))
            i = int(np.argmax(snr))
            if snr[i] > best[0] * (1 + 1e-12) + 1e-12:
                best = (snr[i], p, d, depth[i])
    return best


def summed(t, y, e, width):
    at, where = np.unique(np.floor(t / width).astype(int), return_inverse=True)
    w = 1 / e**2
    return at, np.bincount(where, w), np.bincount(where, w * y)


@pytest.mark.parametrize("seed", range(4))
def test_kernel(seed):
    rng = np.random.default_rng(seed)
    n = (5, 40, 300, 60)[seed]
    t, y, e = np.sort(rng.uniform(100, 130, n)), 1 + rng.normal(0, 0.1, n), rng.uniform(0.05, 0.2, n)
    if seed == 3:
        t = np.round(t, 1)  # many points of one bin
    durations = np.array([0.02, 0.1, 0.31, 0.5])
    periods = boxes.period_grid(0.3, 12, 150)
    bins = summed(t, y, e, 0.002)
    snr, which, first, depth = boxes.best_boxes(*bins, 0.002, periods, durations)
    for i, p in enumerate(periods):
        want = plain_boxes(*bins, 0.002, [p], durations)
        assert snr[i] == pytest.approx(want[0]) and depth[i] == pytest.approx(want[3])
    i = int(np.argmax(snr))
    assert (periods[i], durations[which[i]]) == pytest.approx(plain_boxes(*bins, 0.002, periods, durations)[1:3])


def test_full_grid_query(spark, data):
    """Every tenth key of the registered query over its whole grid of 15,000 periods."""
    got = {r.k: r for r in catalog.queries()["box_least_squares"](spark, data).collect()}
    e = pd.read_parquet(f"{data}/events.parquet")
    e["t"] = e["ts"].astype("int64") / {"us": 86400e6, "ns": 86400e9}[np.datetime_data(e["ts"].dtype)[0]]
    e["flux"] = e["value"] / e.groupby("user_id")["value"].transform("median")
    assert set(got) == set(e["user_id"])
    for k in sorted(got)[::10]:
        part = e[e["user_id"] == k]
        t = part["t"].to_numpy()
        durations = np.geomspace(0.02, 0.5, 10)
        bins = summed(t, part["flux"].to_numpy(), np.full(len(t), 0.05), 0.002)
        top = min(39.8, np.ptp(t) / 2)
        want = plain_boxes(*bins, 0.002, np.geomspace(0.65, top, 15_000)[::1], durations)
        assert (got[k].snr, got[k].period, got[k].depth) == pytest.approx((want[0], want[1], want[3]), rel=1e-5, abs=2e-6)


def planted(k, depth, period=1.3, duration=0.05, days=60, n=700, seed=3, noise=0.02):
    rng = np.random.default_rng([seed, k])
    t = np.sort(rng.uniform(0, days, n))
    y = 1 + rng.normal(0, noise, n)
    y[np.abs(np.mod(t - 0.4 + period / 2, period) - period / 2) <= duration / 2] *= 1 - depth
    return pd.DataFrame({"k": k, "t": t, "flux": y, "flux_err": 0.02, "period": period, "duration": duration})


def test_assessed_periods_find_what_is_planted(spark):
    df = spark.createDataFrame(pd.concat([planted(1, 0.3), planted(2, 0.0), planted(3, 0.0, n=40, noise=0.5)]))
    got = {r.k: r for r in boxes.assess_periods(df, "k", F.lit(0.3)).collect()}
    assert got[1].verdict == "CONFIRMED" and got[1].p_value < 0.01 and got[1].n_events > 10 and abs(got[1].found / 1.3 - 1) < 2e-3
    assert got[1].depth_ratio == pytest.approx(1.0, abs=0.2) and got[1].n_controls == 300
    assert got[2].verdict == "NOT_SEEN" and got[2].power > 0.9 and got[2].p_value > 0.02
    assert got[3].verdict == "INCONCLUSIVE" and got[3].power < 0.5
    # as many tasks as one likes
    dealt = {r.k: r for r in boxes.assess_periods(df, "k", F.lit(0.3), max_bins=30).collect()}
    for k, r in got.items():
        assert [v if isinstance(v, str) else pytest.approx(v) for v in r] == list(dealt[k])


def test_assessed_periods_against_loops(spark):
    """20 keys over whole grids, the scans' draws taken from the operator's own tables."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame(pd.concat([planted(k, 0.3 * (k % 2), 0.9 + 0.07 * k, 0.1 + 0.01 * k, 30, int(rng.integers(45, 80))) for k in range(20)]))
    got = {r.k: r for r in boxes.assess_periods(df, "k", F.lit(0.3), controls=40, injections=6, seed=5).collect()}
    frame = df.toPandas()
    info = frame.groupby("k").agg(period=("period", "first"), duration=("duration", "first"), start=("t", "min"), end=("t", "max")).reset_index()
    info["span"] = info["end"] - info["start"]
    eph = spark.createDataFrame(info)
    ratios = boxes.control_ratios(eph, "k", 40, 5).toPandas()
    simple = sorted({a / b for a in range(1, 5) for b in range(1, 5)})
    assert all(abs(r / s - 1) >= 0.02 for r in ratios["ratio"] for s in simple) and ratios.groupby("k")["nth"].nunique().max() == 40
    draws = eph.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(5)))).select("k", "nth", boxes.draw(6, "k", "nth").alias("a"), boxes.draw(7, "k", "nth").alias("b")).toPandas()
    for row in info.itertuples():
        part = frame[frame["k"] == row.k]
        width = row.duration * 0.7 / 10
        at, w, wy = summed(part["t"].to_numpy(), part["flux"].to_numpy(), part["flux_err"].to_numpy(), width)
        count = int(np.clip(10 * 0.002 * row.span / row.duration, 20, 4000))
        durations = (0.7 * row.duration, row.duration)
        scan = lambda centre, wy=wy: plain_boxes(at, w, wy, width, np.linspace(centre * 0.998, centre * 1.002, count), durations)  # noqa: B023, E731
        own, controls = scan(row.period), [scan(row.period * r)[0] for r in ratios[ratios["k"] == row.k]["ratio"]]
        threshold, hits = np.quantile(controls, 0.99), 0
        for d in draws[draws["k"] == row.k].itertuples():
            p = row.period * (1 + (2 * d.a - 1) * 0.7 * 0.002)
            inside = np.abs(np.mod((at + 0.5) * width - (row.start + d.b * p) + p / 2, p) - p / 2) <= row.duration / 2
            hits += scan(row.period, np.where(inside, wy * 0.7, wy))[0] >= threshold
        r = got[row.k]
        assert (r.snr, r.found_depth, r.threshold) == pytest.approx((own[0], own[3], threshold))
        assert r.p_value == pytest.approx((1 + sum(c >= own[0] for c in controls)) / (1 + len(controls))) and r.power == pytest.approx(hits / 6)


def test_few_controls_give_no_threshold(spark):
    df = spark.createDataFrame(planted(1, 0.3))
    r = boxes.assess_periods(df, "k", F.lit(0.3), controls=10, injections=2).first()
    assert r.n_controls == 10 and r.threshold is None and r.power == 0
    assert boxes.assess_periods(df.limit(0), "k", F.lit(0.3), controls=5, injections=2).count() == 0


def test_boxes_of_few_bins_equal_the_sorted_ones(monkeypatch):
    rng = np.random.default_rng(6)
    width, durations = 0.028, np.array([0.28, 0.4])
    for n, several in ((3, 1), (65, 1), (65, 40), (100, 40)):
        at = 700_000 + np.sort(rng.choice(1_100, n, replace=False))
        w = rng.choice([400.0, 800.0], n)
        # short periods hold long runs; 2.01 puts bins on edges
        periods = np.concatenate([rng.uniform(0.41, 0.9, 18), rng.uniform(1.0, 6.0, 20), [0.3, 2.01]])
        wy = w * rng.normal(1, 0.3, (len(periods), n) if several > 1 else n)
        got = boxes._few_boxes((at + 0.5) * width, w, wy - w * (wy.sum(axis=-1, keepdims=True) / w.sum()), w.sum(), width, periods, np.rint(durations / width).astype(np.int64), durations)
        monkeypatch.setattr(boxes, "FEW_BINS", 0)
        want = boxes.best_boxes(at, w, wy, width, periods, durations)
        monkeypatch.undo()
        for x, y in zip(got, want):
            np.testing.assert_array_equal(x, y)


def test_each_control_is_drawn_once(spark):
    ephemeris = spark.createDataFrame([(k, 1.7 + k / 10, 0.4, 30.0) for k in range(3)], "k long, period double, duration double, span double")
    got = boxes.control_ratios(ephemeris, "k", 50, 1)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    rows = got.collect()
    assert sorted((r.k, r.nth) for r in rows) == [(k, n) for k in range(3) for n in range(50)]
    assert all(abs(r.ratio / (a / b) - 1) >= boxes.HARMONIC for r in rows for a in range(1, 5) for b in range(1, 5))
