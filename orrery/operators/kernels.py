"""Periodic tests and timing: sums over trial grids where they can be expressed, grouped numpy kernels where not.

The grouped kernels take one object's points at a time; ``event_times`` deals those of an object with more than
``max_points`` to several tasks and adds their sums. The box searches are in ``boxes``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import scalars as S
from orrery.functions.stats import draw, median
from orrery.tables import spread, written

#: Points near events that a task of ``event_times`` takes at once, and those that it holds against all shifts together.
MAX_POINTS, BLOCK = 100_000, 4_096
#: Relative difference below which two sums of the same points are equal.
SAME = 1e-9


def box_scan(df: DataFrame, key: list[str], trials: list[float] | None = None, bins=50, width_bins=2, t="t", y="flux", err="flux_err") -> DataFrame:
    """The same search by joins and sums alone, for narrow grids: points times trial periods, folded into phase bins,
    boxes as window sums over the bins. One row a key: the trial of greatest signal to noise."""
    p = F.explode(F.array(*[F.lit(float(x)) for x in trials])).alias("trial") if trials else F.explode("trials").alias("trial")
    w = 1 / F.pow(F.col(err), 2)
    rows = df.select(*key, t, y, w.alias("w"), p)
    binned = rows.withColumn("bin", F.floor(F.pmod(F.col(t) / F.col("trial"), F.lit(1.0)) * bins)).groupBy(*key, "trial", "bin").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col(y)).alias("wy"))
    every = Window.partitionBy(*key, "trial")
    box = every.orderBy("bin").rangeBetween(0, width_bins - 1)
    # boxes that wrap around the last bin see the first bins again
    wrapped = binned.unionByName(binned.filter(F.col("bin") < width_bins - 1).withColumn("bin", F.col("bin") + bins))
    sums = wrapped.withColumns({"iw": F.sum("w").over(box), "iy": F.sum("wy").over(box), "aw": F.sum(F.when(F.col("bin") < bins, F.col("w"))).over(every), "ay": F.sum(F.when(F.col("bin") < bins, F.col("wy"))).over(every)}).filter(F.col("bin") < bins)
    ow, oy = F.col("aw") - F.col("iw"), F.col("ay") - F.col("iy")
    depth = F.try_divide(oy, ow) - F.try_divide("iy", "iw")
    snr = F.when((ow > 1e-9 * F.col("aw")) & (F.col("iw") > 0), depth / F.sqrt(F.try_divide(F.lit(1.0), F.col("iw")) + F.try_divide(F.lit(1.0), ow)))
    best = sums.withColumns({"depth": depth, "snr": snr}).filter("snr IS NOT NULL").groupBy(*key).agg(F.max_by(F.struct("trial", "bin", "depth", "snr"), F.struct(F.round("snr", 9), -F.col("trial"), -F.col("bin"))).alias("b"))
    return best.select(*key, F.col("b.trial").alias("period"), (F.col("b.bin") * F.col("b.trial") / bins).alias("start"), F.col("b.depth").alias("depth"), F.col("b.snr").alias("snr"))


def lomb_scargle(df: DataFrame, key: list[str], frequencies: list[float], t="t", y="flux") -> DataFrame:
    """Per key: the frequency of greatest power (floating phase), from sums over points times trial frequencies."""
    centred = df.withColumn("__y", F.col(y) - F.avg(y).over(Window.partitionBy(*key)))
    rows = centred.select(*key, t, "__y", F.explode(F.array(*[F.lit(float(f)) for f in frequencies])).alias("frequency"))
    a = 2 * np.pi * F.col("frequency") * F.col(t)
    m = rows.withColumns({"c": F.cos(a), "s": F.sin(a)}).groupBy(*key, "frequency").agg(
        F.sum(F.col("__y") * F.col("c")).alias("yc"), F.sum(F.col("__y") * F.col("s")).alias("ys"), F.sum(F.col("c") * F.col("c")).alias("cc"), F.sum(F.col("s") * F.col("s")).alias("ss"),
        F.sum(F.col("c") * F.col("s")).alias("cs"), F.sum(F.col("__y") * F.col("__y")).alias("yy"),
    )
    d = F.nullif(F.col("cc") * F.col("ss") - F.col("cs") * F.col("cs"), F.lit(0.0))
    power = (F.col("ss") * F.col("yc") * F.col("yc") + F.col("cc") * F.col("ys") * F.col("ys") - 2 * F.col("cs") * F.col("yc") * F.col("ys")) / d / F.nullif("yy", F.lit(0.0))
    best = m.withColumn("power", power).groupBy(*key).agg(F.max_by(F.struct("frequency", "power"), F.struct(F.round("power", 9), -F.col("frequency"))).alias("b"))
    return best.select(*key, "b.frequency", "b.power")


def fold_test(df: DataFrame, key: list[str], shifts=200, t="t", y="flux", err="flux_err") -> DataFrame:
    """Per key: weighted depth at the ephemeris, its z, and the share of phase shifts that do at least as well. Shifts that
    hold the same points differ in the last bits where their sums were merged in other orders; they do as well."""
    w = 1 / F.pow(F.col(err), 2)
    rows = df.select(*key, t, y, "period", "t0", "duration", w.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(shifts - 1))).alias("__k"))
    inside = S.in_event(t, "period", F.col("t0") + F.col("__k") * F.col("period") / shifts, "duration")
    m = rows.withColumn("i", inside).groupBy(*key, "__k").agg(*[F.sum(F.when(F.col("i") == flag, v)).alias(n) for flag, v, n in ((True, F.col("w"), "a"), (True, F.col("w") * F.col(y), "b"), (False, F.col("w"), "c"), (False, F.col("w") * F.col(y), "d"))])
    depth = F.col("d") / F.col("c") - F.col("b") / F.col("a")
    m = m.withColumn("depth", depth).withColumn("z", depth / F.sqrt(1 / F.col("a") + 1 / F.col("c")))
    own = m.filter("__k = 0").select(*key, "depth", "z")
    rest = m.filter("__k > 0 AND z IS NOT NULL").select(*key, F.col("z").alias("z_k"))
    joined = own.join(rest, key, "left").groupBy(*key, "depth", "z").agg(F.count("z_k").alias("n"), F.count(F.when(F.col("z_k") >= F.col("z") - SAME * F.greatest(F.abs("z"), F.lit(1.0)), 1)).alias("hits"))
    return joined.select(*key, "depth", "z", ((1 + F.col("hits")) / (1 + F.col("n"))).alias("p_value"))


def refine_t0(df: DataFrame, key: list[str], steps=41, widths=1.0, t="t", y="flux") -> DataFrame:
    """Per key: the offset of t0, within so many durations, of the deepest event by medians."""
    k = F.explode(F.sequence(F.lit(-(steps // 2)), F.lit(steps // 2))).alias("__k")
    rows = df.select(*key, t, y, "period", "t0", "duration", k).withColumn("offset", F.col("__k") * widths * F.col("duration") / (steps // 2))
    inside = S.in_event(t, "period", F.col("t0") + F.col("offset"), "duration", 0.5)
    m = rows.filter(inside).groupBy(*key, "__k", "offset").agg(median(y).alias("m"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return m.groupBy(*key).agg(F.min_by(F.struct("offset", "m"), F.struct("m", F.abs("__k"), "__k")).alias("b")).select(*key, "b.offset", F.col("b.m").alias("flux"))


def control_periods(df: DataFrame, key: str, n: int, seed, low=0.3, high=13.0, harmonics=4, reject=0.02) -> DataFrame:
    """(key, k, trial): log-uniform draws away from every ratio of small numbers of the key's period."""
    rows = df.select(key, "period", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")).withColumn("trial", low * F.pow(F.lit(high / low), draw(seed, key, "k")))
    ratios = sorted({a / b for a in range(1, harmonics + 1) for b in range(1, harmonics + 1)})
    far = F.forall(F.array(*[F.lit(r) for r in ratios]), lambda r: F.abs(F.col("trial") / F.col("period") / r - 1) >= reject)
    return rows.filter(far).select(key, "k", "trial")


# -- timing -----------------------------------------------------------------------------------------------------------


def _peak(top: np.ndarray, bottom: np.ndarray, grid: np.ndarray, least_gain: float) -> tuple | None:
    """(shift, its error, amplitude, gain) of an event from its sums at the shifts of a grid; None without a clear peak."""
    gain = np.where((bottom > 0) & (top > 0), top * top / np.maximum(bottom, 1e-300), 0.0)
    i = int(np.argmax(gain))
    if gain[i] < least_gain or i in (0, len(grid) - 1):
        return None
    a, b, c = gain[i - 1 : i + 2]
    bend, step = a - 2 * b + c, grid[1] - grid[0]
    if bend >= 0:
        return None
    return grid[i] + 0.5 * (a - c) / bend * step, float(np.sqrt(2.0 / (-bend)) * step), float(top[i] / bottom[i]), float(b)


def event_times(df: DataFrame, key: str, t="t", y="flux", err="flux_err", shifts=201, widths=1.0, least=5, bins=40, least_gain=4.0, max_points=MAX_POINTS) -> DataFrame:
    """(key, epoch): time of each event by sliding the object's folded template along it. At each shift the amplitude is
    the closed-form least-squares one; a parabola through the best three gives the time, its curvature the error.

    Templates are medians by aggregation. An object of up to ``max_points`` points near its events is a task's; of a larger
    one each event is dealt out in parts of about that size, whose sums at each shift are added."""
    kind = df.schema[key].dataType.simpleString()
    names = {"t": t, "y": y, "e": err, "period": "period", "t0": "t0", "duration": "duration"}
    points, there = df.select(key, *[F.col(c).cast("double").alias(a) for a, c in names.items()]), F.col(key).isNotNull()
    for c in names:
        there = there & F.col(c).isNotNull() & ~F.isnan(c)
    d, n = F.col("duration"), F.rint((F.col("t") - F.col("t0")) / F.col("period"))
    dt = F.col("t") - F.col("t0") - n * F.col("period")
    points = written(points.filter(there).withColumns({"epoch": n.cast("long"), "dt": dt, "near": F.abs(dt) < 1.5 * d}), "event-points")
    near = points.filter("near")
    # the bin by division, then by the edges themselves
    edge = lambda i: i * (3.0 * d / bins) - 1.5 * d
    bin_ = F.floor((F.col("dt") + 1.5 * d) / (3.0 * d) * bins)
    bin_ = bin_ + F.when(F.col("dt") < edge(bin_), -1).when(F.col("dt") >= edge(bin_ + 1), 1).otherwise(0)
    shape = near.groupBy(key, F.least(F.greatest(bin_, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")).agg(median("y").alias("m"), F.count(F.lit(1)).alias("n"))
    shape = shape.groupBy(key).agg(F.sum("n").alias("n"), F.collect_list(F.struct("bin", "m")).alias("shape"))
    level = points.filter("NOT near").groupBy(key).agg(median("y").alias("base"))
    bare = near.join(level, key, "left_anti").groupBy(key).agg(median("y").alias("base"))
    first = points.groupBy(key).agg(*[F.first(c).alias(c) for c in ("period", "t0", "duration")])
    objects = written(shape.filter(F.size("shape") >= 3).join(level.unionByName(bare), key).join(first, key), "event-objects")  # a row an object
    sizes = near.join(objects.filter(F.col("n") > max_points).select(key), key).groupBy(key, "epoch").agg(F.ceil(F.count(F.lit(1)) / max_points).alias("parts"))
    sizes = written(sizes, "event-sizes")  # a row an event of the larger ones
    place = lambda i: F.xxhash64("epoch", i)
    none = F.lit(0).cast("long")
    dealt = near.join(sizes, [key, "epoch"], "left").withColumn("part", F.when(F.col("parts").isNull(), none).otherwise(place(F.pmod(F.xxhash64("t", "y"), "parts"))))
    dealt = dealt.select(F.col(key).alias("__own"), "part", "epoch", F.coalesce("parts", F.lit(1)).alias("parts"), "dt", "y", "e")
    all_parts = F.when(F.col("parts").isNull(), F.array(none)).otherwise(F.transform(F.sequence(none, F.col("parts") - 1), place))
    wanted = objects.join(sizes, key, "left").withColumn("part", F.explode(all_parts)).select(key, "part", "period", "t0", "duration", "base", F.col("shape.bin").alias("bin"), F.col("shape.m").alias("m")).dropDuplicates([key, "part"])
    fields = "epoch long, time double, time_err double, amplitude double, gain double"
    sums = "n long, period double, t0 double, duration double, top array<double>, bottom array<double>"
    columns = [c.split()[0] for c in f"{fields}, {sums}".split(", ")]

    def run(name, part: pd.DataFrame, object_: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(part) and len(object_):
            p, t0, d, base = (float(object_[c].iloc[0]) for c in ("period", "t0", "duration", "base"))
            order = np.argsort(object_["bin"].iloc[0])
            edges = np.linspace(-1.5 * d, 1.5 * d, bins + 1)
            centres = ((edges[1:] + edges[:-1]) / 2)[np.asarray(object_["bin"].iloc[0])[order]]
            shape = base - np.asarray(object_["m"].iloc[0], dtype=float)[order]
            grid = np.linspace(-widths * d, widths * d, shifts)
            for k, event in part.sort_values(["epoch", "dt", "y", "e"]).groupby("epoch"):
                dt, w, r = event["dt"].to_numpy(), 1 / event["e"].to_numpy() ** 2, base - event["y"].to_numpy()
                several = int(event["parts"].iloc[0]) > 1
                if len(event) < least and not several:
                    continue
                top, bottom = np.zeros(shifts), np.zeros(shifts)
                for a in range(0, len(event), BLOCK):
                    i = slice(a, a + BLOCK)
                    model = np.interp(dt[None, i] - grid[:, None], centres, shape, left=0.0, right=0.0)
                    top += (model * (w[i] * r[i])).sum(1)
                    bottom += (model * model * w[i]).sum(1)
                if several:
                    out.append((name[0], int(k), None, None, None, None, len(event), p, t0, d, top.tolist(), bottom.tolist()))
                elif found := _peak(top, bottom, grid, least_gain):
                    out.append((name[0], int(k), t0 + k * p + found[0], *found[1:], len(event), p, t0, d, None, None))
        return pd.DataFrame(out, columns=[key, *columns])

    def add(name, parts: pd.DataFrame) -> pd.DataFrame:
        p, t0, d = (float(parts[c].iloc[0]) for c in ("period", "t0", "duration"))
        top, bottom = (np.sum(np.stack(sorted(map(tuple, parts[c]))), axis=0) for c in ("top", "bottom"))
        found = _peak(top, bottom, np.linspace(-widths * d, widths * d, shifts), least_gain) if parts["n"].sum() >= least else None
        return pd.DataFrame([(*name, t0 + name[1] * p + found[0], *found[1:])] if found else [], columns=[key, *columns[:5]])

    met = spread(dealt, "__own", "part").groupBy("__own", "part").cogroup(spread(wanted, key, "part").groupBy(key, "part"))
    met = written(met.applyInPandas(lambda name, part, object_: run(name, part, object_), f"{key} {kind}, {fields}, {sums}"), "event-sums")
    whole = met.filter("top IS NULL").select(key, *columns[:5])
    return whole.unionByName(met.filter("top IS NOT NULL").groupBy(key, "epoch").applyInPandas(lambda name, parts: add(name, parts), f"{key} {kind}, {fields}"))


def gls_line(cycle: np.ndarray, time: np.ndarray, err: np.ndarray, group: np.ndarray) -> dict:
    """Straight line through times with white and per-group noise, both by restricted likelihood on a refined grid."""
    x = np.stack([np.ones(len(cycle)), cycle], axis=1).astype(float)
    err = np.maximum(err, max(1e-4 * float(err.max()), 1e-9))  # points without error would leave no inverse
    same = (group[:, None] == group[None, :]).astype(float)

    def solve(white: float, shared: float):
        cov = np.diag(err**2 + white**2) + shared**2 * same
        try:
            chol = np.linalg.cholesky(cov)
        except np.linalg.LinAlgError:
            return None, None, -np.inf
        xs, ys = np.linalg.solve(chol, x), np.linalg.solve(chol, time)
        info = xs.T @ xs
        beta = np.linalg.solve(info, xs.T @ ys)
        rest = ys - xs @ beta
        return beta, np.linalg.inv(info), -np.log(np.diag(chol)).sum() - 0.5 * np.linalg.slogdet(info)[1] - 0.5 * rest @ rest

    scale = max(float(np.median(err)), 1e-9)
    grid, ratio = np.concatenate([[0.0], scale * np.geomspace(0.05, 50, 10)]), 1000 ** (1 / 9)
    several = len(np.unique(group)) > 1
    best = max(((w, s) for w in grid for s in (grid if several else [0.0])), key=lambda v: solve(*v)[2])
    for power in (0.4, 0.12):
        tries = [(best[0] * ratio ** (power * a), best[1] * ratio ** (power * b)) for a in range(-2, 3) for b in range(-2, 3)]
        best = max(tries, key=lambda v: solve(*v)[2])
    beta, cov, _ = solve(*best)
    return {"t0": beta[0], "period": beta[1], "t0_err": float(np.sqrt(cov[0, 0])), "period_err": float(np.sqrt(cov[1, 1])), "cov": float(cov[0, 1]), "white": best[0], "shared": best[1]}


def gamma_tail(a: float, x: float) -> float:
    """Upper regularised incomplete gamma function, by series or continued fraction."""
    from math import exp, lgamma, log

    if x <= 0:
        return 1.0
    front = exp(-x + a * log(x) - lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > 1e-15 * abs(total):
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * front)
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_tail(x: float, k: int) -> float:
    return gamma_tail(k / 2.0, x / 2.0)


def aperture_share(sep: float, radius: float, width: float) -> float:
    """Share of a Gaussian source's light inside a circle sep away from it: a Poisson-weighted series."""
    from math import exp

    x, lam = radius**2 / width**2, sep**2 / width**2
    weight, total, j = exp(-lam / 2), 0.0, 0
    while j < 2000:
        total += weight * (1 - gamma_tail(1.0 + j, x / 2))
        j += 1
        weight *= lam / 2 / j
        if weight < 1e-17 and j > lam / 2:
            break
    return min(1.0, total)


def fit_lines(times: DataFrame, key: str, cycle="epoch", time="time", err="time_err", group="sector", least=3) -> DataFrame:
    """Per key: the noise-aware line, and its leave-one-group-out test: least p-value and number of groups tested."""
    kind = times.schema[key].dataType.simpleString()
    fields = "n long, t0 double, period double, t0_err double, period_err double, white double, shared double, n_tests long, least_p double, longest_lag double"

    def run(name, part: pd.DataFrame) -> pd.DataFrame:
        part = part.dropna().sort_values("c")
        n, x, y, e, g = len(part), *(part[c].to_numpy(dtype=float) for c in ("c", "y", "e")), part["g"].to_numpy()
        if n < least or len(np.unique(x)) < 2:
            return pd.DataFrame([(name[0], n, *[None] * 6, 0, None, None)], columns=[key, *[f.split()[0] for f in fields.split(", ")]])
        f, tests, lags = gls_line(x, y, e, g), [], []
        for held in np.unique(g):
            rest = g != held
            if rest.sum() < least or len(np.unique(x[rest])) < 2:
                continue
            r = gls_line(x[rest], y[rest], e[rest], g[rest])
            m = ~rest
            gap = y[m] - r["t0"] - r["period"] * x[m]
            w = 1 / (e[m] ** 2 + r["white"] ** 2)
            at = (w * x[m]).sum() / w.sum()
            var = 1 / w.sum() + r["shared"] ** 2 + r["t0_err"] ** 2 + 2 * at * r["cov"] + at**2 * r["period_err"] ** 2
            tests.append(chi2_tail(float(((w * gap).sum() / w.sum()) ** 2 / var), 1))
            lags.append(float(max(0.0, y[m].min() - y[rest].max())))
        return pd.DataFrame([(name[0], n, f["t0"], f["period"], f["t0_err"], f["period_err"], f["white"], f["shared"], len(tests), min(tests, default=None), max(lags, default=None))], columns=[key, *[c.split()[0] for c in fields.split(", ")]])

    rows = times.select(key, F.col(cycle).alias("c"), F.col(time).alias("y"), F.col(err).alias("e"), F.col(group).alias("g"))
    return rows.groupBy(key).applyInPandas(lambda name, part: run(name, part), f"{key} {kind}, {fields}")


def predict_times(fits: DataFrame, windows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, window, cycle, time, sigma): every whole cycle inside each window. Windows are a small calendar table."""
    met = fits.crossJoin(F.broadcast(windows))
    first, last = F.ceil((F.col("lo") - F.col("t0")) / F.col("period")), F.floor((F.col("hi") - F.col("t0")) / F.col("period"))
    rows = met.filter(first <= last).select(*keep, "window", "t0", "period", "t0_err", "period_err", F.explode(F.sequence(first, last)).alias("cycle"))
    return rows.select(*keep, "window", "cycle", (F.col("t0") + F.col("cycle") * F.col("period")).alias("time"), F.hypot(F.col("t0_err"), F.col("cycle") * F.col("period_err")).alias("sigma"))


def connect_parts(parts: DataFrame, key: str, n_sigma=3.0, most_cycle_error=0.25) -> DataFrame:
    """Greedy phase connection of (key, part, time, time_err, period, period_err): from the part of least error outward in
    time, a part joins when the cycle count to it is unambiguous; adds cycle and joined. State is sequential, so a key is
    one task."""
    kind = parts.schema[key].dataType.simpleString()

    def run(name, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("time", ignore_index=True)
        x, e = rows["time"].to_numpy(), rows["time_err"].to_numpy()
        p, s = float(rows["period"].iloc[0]), float(rows["period_err"].iloc[0])
        start = int(np.argmin(e))
        cycle, joined = np.full(len(rows), np.nan), np.zeros(len(rows), dtype=bool)
        cycle[start], joined[start] = 0, True
        for i in sorted(range(len(rows)), key=lambda i: abs(x[i] - x[start])):
            if joined[i]:
                continue
            have = np.flatnonzero(joined)
            near = have[np.argmin(np.abs(x[have] - x[i]))]
            n = (x[i] - x[near]) / p
            error = np.hypot(np.hypot(e[i], e[near]) / p, abs(n) * s / p)
            if error * n_sigma > 0.5 or error > most_cycle_error or abs(n - round(n)) > n_sigma * error + 0.05:
                continue
            cycle[i], joined[i] = cycle[near] + round(n), True
            have = np.flatnonzero(joined)
            if len(np.unique(cycle[have])) > 1:
                w = 1 / e[have] ** 2
                c = cycle[have] - (w * cycle[have]).sum() / w.sum()
                slope = (w * c * x[have]).sum() / (w * c * c).sum()
                p, s = float(slope), float(1 / np.sqrt((w * c * c).sum()))
        return pd.DataFrame({key: name[0], "part": rows["part"], "cycle": pd.array([None if np.isnan(c) else int(c) for c in cycle], dtype="Int64"), "joined": joined})

    return parts.select(key, "part", "time", "time_err", "period", "period_err").groupBy(key).applyInPandas(lambda name, rows: run(name, rows), f"{key} {kind}, part long, cycle long, joined boolean")


def sinusoid_fit(df: DataFrame, key: list[str], t="t", y="v", err="v_err") -> DataFrame:
    """Per key: weighted A sin + B cos + C at the key's period from normal-equation sums (Cramer's rule), with K and the
    gain in chi-square over a constant."""
    a = 2 * np.pi * (F.col(t) - F.col("t0")) / F.col("period")
    r = df.withColumns({"s": F.sin(a), "c": F.cos(a), "w": 1 / F.pow(F.col(err), 2), "y": F.col(y)})
    terms = {"w": "w", "ws": "w*s", "wc": "w*c", "wss": "w*s*s", "wsc": "w*s*c", "wcc": "w*c*c", "wy": "w*y", "wsy": "w*s*y", "wcy": "w*c*y", "wyy": "w*y*y"}
    m = r.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(v)).alias(f"z_{k}") for k, v in terms.items()])
    z = {k: F.col(f"z_{k}") for k in terms}
    def det(x):
        return x[0][0] * (x[1][1] * x[2][2] - x[1][2] * x[2][1]) - x[0][1] * (x[1][0] * x[2][2] - x[1][2] * x[2][0]) + x[0][2] * (x[1][0] * x[2][1] - x[1][1] * x[2][0])

    rows = [[z["wss"], z["wsc"], z["ws"]], [z["wsc"], z["wcc"], z["wc"]], [z["ws"], z["wc"], z["w"]]]
    right = [z["wsy"], z["wcy"], z["wy"]]
    whole = F.nullif(det(rows), F.lit(0.0))
    part = lambda j: det([[right[i] if k == j else rows[i][k] for k in range(3)] for i in range(3)]) / whole
    got = m.withColumns({"a": part(0), "b": part(1), "gamma": part(2)})
    gain = got["a"] * F.col("z_wsy") + got["b"] * F.col("z_wcy") + got["gamma"] * F.col("z_wy") - F.col("z_wy") * F.col("z_wy") / F.col("z_w")
    return got.select(*key, "n", F.hypot(F.col("a"), F.col("b")).alias("k"), "gamma", gain.alias("delta_chi2"))


def third_body_grid(df: DataFrame, key: list[str], periods: list[float], t="t", y="oc", err="oc_err") -> DataFrame:
    """Per key: the trial outer period whose sinusoid gains most over a constant."""
    trial = F.explode(F.array(*[F.lit(float(p)) for p in periods])).alias("period")
    rows = df.select(*key, t, y, err, F.lit(0.0).alias("t0"), trial)
    got = sinusoid_fit(rows, [*key, "period"], t, y, err)
    return got.groupBy(*key).agg(F.max_by(F.struct("period", "k", "delta_chi2"), F.struct(F.round("delta_chi2", 6), -F.col("period"))).alias("b")).select(*key, "b.*")


def difference_image(cube: DataFrame, key: list[str], t="t", y="flux") -> DataFrame:
    """From a long cube (key, row, col, t, flux): per key the peak pixel of out-of-event minus in-event medians, the 3x3
    centroid about it, and the share of the positive difference inside the 3x3."""
    inside = S.in_event(t, "period", "t0", "duration")
    pixels = cube.withColumn("__in", inside).groupBy(*key, "row", "col").agg((F.percentile(F.when(~F.col("__in"), F.col(y)), 0.5) - F.percentile(F.when(F.col("__in"), F.col(y)), 0.5)).alias("d")).filter("d IS NOT NULL")
    peak = pixels.groupBy(*key).agg(F.max_by(F.struct("row", "col", "d"), F.struct("d", -F.col("row"), -F.col("col"))).alias("p"), F.sum(F.greatest("d", F.lit(0.0))).alias("total"))
    near = pixels.join(peak, key).filter((F.abs(F.col("row") - F.col("p.row")) <= 1) & (F.abs(F.col("col") - F.col("p.col")) <= 1)).withColumn("g", F.greatest("d", F.lit(0.0)))
    got = near.groupBy(*key).agg(F.first("p").alias("p"), F.first("total").alias("total"), F.sum("g").alias("s"), F.sum(F.col("g") * F.col("row")).alias("sr"), F.sum(F.col("g") * F.col("col")).alias("sc"))
    return got.select(*key, F.col("p.row").alias("peak_row"), F.col("p.col").alias("peak_col"), F.col("p.d").alias("peak"), F.try_divide("sr", "s").alias("row_centroid"), F.try_divide("sc", "s").alias("col_centroid"), F.try_divide("s", "total").alias("compactness"))
