"""Full vetting against a plain version of every gate, and the injection loop on planted series."""

import numpy as np
import pandas as pd
import pytest

from orrery.operators import vetting
from orrery.plans.base import Tables
from test_boxes import plain_boxes, summed

PERIODS = 250


def mad(x):
    return 1.4826 * np.median(np.abs(x - np.median(x)))


def plain_vetting(t, f, e, least):
    """The same gates by masks and loops, for one series; a dict."""
    finite = np.isfinite(t) & np.isfinite(f)
    kept = finite & (f > 0) & (f < 2.5)
    out = {"n_raw": len(t), "n_points": int(kept.sum()), "n_dropped": int((finite & ~kept).sum())}
    if out["n_dropped"] / len(t) > 0.3:
        return out | {"status": "UNRELIABLE_DATA"}
    if kept.sum() < least:
        return out | {"status": "TOO_FEW_POINTS"}
    t, f, e = t[kept], f[kept], e[kept]
    top = min(39.8, np.ptp(t) / 2)
    if top <= 0.65:
        return out | {"status": "BASELINE_TOO_SHORT"}
    e = np.where(np.isfinite(e) & (e > 0), e, f.std() or 1e-6)
    snr, p, d, depth = plain_boxes(*summed(t, f, e, 0.002), 0.002, np.geomspace(0.65, top, PERIODS), np.geomspace(0.02, 0.5, 10))
    return out | {"status": "OK", "snr": snr, "period": p, "duration": d, "depth": depth, "share_bright": (f > 1.2).mean()}


def plain_gates(t, f, r):
    """Gates at the ephemeris that the search gave."""
    p, t0, d = r.period, r.t0, r.duration
    x = np.mod(t - t0 + p / 2, p) / p - 0.5
    inside = np.abs(x) < d / p / 2
    epoch = np.rint((t - t0) / p).astype(int)
    counts = np.unique(epoch[inside], return_counts=True)[1]
    ts = np.sort(t)
    cut = np.flatnonzero(np.diff(ts) > 0.5)
    edges = np.concatenate([ts[cut], ts[cut + 1]])
    near = lambda s: float(np.mean([np.abs(edges - v).min() < 0.5 for v in s])) if len(edges) and len(s) else 0.0
    deep = np.median(f[~inside]) - np.median(f[inside]) if inside.sum() >= 3 else None
    sigma = deep / (mad(f[~inside]) * np.sqrt(np.pi / 2 / inside.sum())) if deep is not None else None
    wide = np.abs(x) < d / p / 2 * 1.2
    odd, even = wide & (epoch % 2 != 0), wide & (epoch % 2 == 0)
    z = None
    if (~wide).sum() >= 10 and odd.sum() >= 3 and even.sum() >= 3:
        z = abs(np.median(f[odd]) - np.median(f[even])) / (f[~wide].std() * np.sqrt(1 / odd.sum() + 1 / even.sum()))
    return {"n_in": int(inside.sum()), "n_events": int((counts >= 3).sum()), "share_in_near_gap": near(t[inside]), "share_near_gap": near(t), "robust_depth": deep, "robust_sigma": sigma, "odd_even_z": z}


def test_vetting_against_masks(spark, data):
    rows = Tables(spark, data).curves.select("g", "t", "flux", "flux_err")
    extra = spark.createDataFrame([(100, float(i), 1.0, 0.01) for i in range(30)] + [(101, 5.0 + i / 100, 1.0 + (i % 7) / 100, 0.01) for i in range(80)] + [(102, None, None, None), (None, 1.0, float("nan"), 0.1)], "g long, t double, flux double, flux_err double")
    rows = rows.unionByName(extra)
    frame = rows.toPandas()
    got = {r.g: r for r in vetting.vetted(rows, "g", n_periods=PERIODS).collect()}
    assert len(got) == frame["g"].nunique(dropna=False) and got[100].status == got[102].status == got[None].status == "TOO_FEW_POINTS" and got[101].status == "BASELINE_TOO_SHORT"
    seen = set()
    for g, part in frame.dropna(subset=["g"]).groupby("g"):
        t, f, e = (part[c].to_numpy(dtype=float) for c in ("t", "flux", "flux_err"))
        want, r = plain_vetting(t, f, e, 50), got[g]
        seen.add(want["status"])
        for k, v in want.items():
            assert r[k] == (v if isinstance(v, (str, int)) else pytest.approx(v, rel=1e-6)), (g, k)
        if want["status"] != "OK":
            assert r.period is None and r.flagged is None and not r.passed
            continue
        kept = (f > 0) & (f < 2.5)
        for k, v in plain_gates(t[kept], f[kept], r).items():
            assert r[k] == (v if v is None else pytest.approx(v, rel=1e-6)), (g, k)
        gates = {
            "too_few_events": r.n_events < 3, "insufficient_points": r.n_in < 10, "below_noise": r.snr < 10, "noisy": r.share_bright > 0.02, "depth_too_small": 0 < r.depth < 1e-5, "implausible_depth": not 0 <= r.depth <= 0.95,
            "not_finite": False, "robust_mismatch": r.robust_depth is None or r.depth <= 0 or r.robust_depth / r.depth < 0.5 or not r.robust_sigma >= 7, "inhomogeneous": r.inhomogeneous,
        }
        assert {k: r[k] for k in vetting.GATES} == gates and r.flagged == any(gates.values()) and r.passed != r.flagged
    assert "OK" in seen and len(seen) > 1


def curve(k, depth, noise=0.002, n=1500, days=27.0, period=2.37):
    rng = np.random.default_rng([4, k])
    t = np.sort(rng.uniform(0, days, n))
    x = np.abs(np.mod(t - 0.7 + period / 2, period) - period / 2)
    return pd.DataFrame({"k": k, "t": t, "flux": 1 + rng.normal(0, noise, n) - depth * np.clip((0.1 - x) / 0.03, 0, 1), "flux_err": noise})


def test_planted_event_passes_and_noise_does_not(spark):
    got = {r.k: r for r in vetting.vetted(spark.createDataFrame(pd.concat([curve(1, 0.08), curve(2, 0.0)])), "k", n_periods=4000).collect()}
    assert got[1].passed and abs(got[1].period / 2.37 - 1) < 0.01 and got[1].depth_ratio == pytest.approx(1, abs=0.3)
    assert got[2].status == "OK" and not got[2].passed and got[2].below_noise


def test_hosts_are_usable_and_fail_the_gates(spark):
    judged = vetting.vetted(spark.createDataFrame(pd.concat([curve(1, 0.0), curve(2, 0.0), curve(3, 0.08)])), "k", n_periods=4000)
    assert {r.k for r in vetting.injection_hosts(judged, "k", "n_points", 1, 5, 3).collect()} == {1, 2}


def test_injection_loop_recovers_deep_events(spark):
    points = spark.createDataFrame(pd.concat([curve(1, 0.0), curve(2, 0.0)])).withColumnRenamed("k", "host")
    hosts = points.select("host").distinct()
    series, truth = vetting.injection_trials(points, hosts, "host", 6, 2, 5)
    truth = {(r.host, r.kind, r.k): r for r in truth.collect()}
    frame = series.toPandas()
    assert len(truth) == 16 and frame.groupby(["host", "kind", "k"]).size().eq(1500).all()
    own = {h: g.sort_values("t") for h, g in points.toPandas().groupby("host")}
    for (host, kind, k), g in frame.groupby(["host", "kind", "k"]):
        g, base, r = g.sort_values("t"), own[host], truth[host, kind, k]
        assert (g["t"].to_numpy() == base["t"].to_numpy()).all()
        if kind == "shuffle":
            assert sorted(g["flux"]) == sorted(base["flux"]) and (g["flux"].to_numpy() != base["flux"].to_numpy()).mean() > 0.5
        else:
            dip = 1 - g["flux"].to_numpy() / base["flux"].to_numpy()
            x = lambda c: np.abs(np.mod(g["t"].to_numpy() - c + r.period / 2, r.period) - r.period / 2)  # noqa: B023, E731
            shape = lambda c, d: d * np.clip((r.duration / 2 - x(c)) / max(r.ingress * r.duration / 2, 1e-9), 0, 1)  # noqa: B023, E731
            assert dip == pytest.approx(shape(r.t0, r.depth) + shape(r.t0 + r.period / 2, r.depth2), abs=1e-9)
            assert 0.65 <= r.period <= 39.8 and 0.002 <= r.depth <= 0.5 and 0 < r.duration < r.period / 2 + 1e-9
    found = {(r.host, r.kind, r.k): r for r in vetting.injection_results(points, hosts, "host", 6, 2, seed=5, n_periods=3000).collect()}
    assert found.keys() == truth.keys()
    outcomes = [r.outcome for (_, kind, _), r in found.items() if kind == "inject" and r.searchable and r.depth > 0.02 and r.duration < 0.5]
    assert outcomes and sum(o in ("exact", "alias") for o in outcomes) >= 0.5 * len(outcomes)
    assert all(r.outcome == "clean" for (_, kind, _), r in found.items() if kind == "shuffle")
    done = spark.createDataFrame([(1, "inject", k) for k in range(6)] + [(2, "shuffle", 0)], "host long, kind string, k int")
    rest = {(r.host, r.kind, r.k): r for r in vetting.injection_results(points, hosts, "host", 6, 2, seed=5, done=done, n_periods=3000).collect()}
    assert rest.keys() == found.keys() - {(1, "inject", k) for k in range(6)} - {(2, "shuffle", 0)} and all(tuple(rest[k]) == tuple(found[k]) for k in rest)


def test_hosts_of_injections_are_worked_out_once(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def own(g):
        seen.add(1)
        return g

    points = spark.range(60).select(F.lit(1).cast("long").alias("g"), (F.col("id") * 0.5).alias("t"), (1 + F.col("id") % 3 * 0.01).alias("flux"), F.lit(0.01).alias("flux_err"))
    hosts = spark.range(1, 2).coalesce(1).select(own("id").alias("g"))
    got = vetting.injection_results(points, hosts, "g", 1, 1, n_periods=10).select("kind", "k").collect()
    assert sorted((r.kind, r.k) for r in got) == [("inject", 0), ("shuffle", 0)]
    assert seen.value == 1
