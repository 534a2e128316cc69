"""Exact medians of boxes in phase over groups of any size, without a row a point and box.

Points are dealt in chunks. A chunk sorts its phases once, so that a box is a slice; it first counts the slice in ranges of
the values, then gives out the values in the ranges that hold the middle ranks. Where ranges are cut changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.tables import spread, written

#: Points of a chunk, ranges of the values, points that a range should hold at least, and parts that a group's boxes are
#: dealt into.
CHUNK, RANGES, LEAST_IN_RANGE, DEALT = 200_000, 200, 50, 16


def slices(phase: np.ndarray, half: float, centres: np.ndarray, reach: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(order, places): an order of the points over three turns, and of each centre the six places in it between which lie
    its left shoulder, its inside and its right shoulder."""
    order, n = np.argsort(phase, kind="stable"), len(phase)
    x = phase[order]
    turns, order = np.concatenate([x - 1, x, x + 1]), np.concatenate([order, order, order])
    first, places = np.searchsorted(turns, centres - 0.5), np.empty((len(centres), 6), dtype=np.int64)
    apart = lambda p, c: np.abs(np.mod(p - c + 0.5, 1.0) - 0.5)
    within = [lambda a: (a < reach[1] * half) & (a / half < reach[1]), lambda a: a / half <= reach[0], lambda a: a / half <= 1]
    for j, (k, side, inner) in enumerate([*zip((reach[1], reach[0], 1.0), (-1, -1, -1), within), *zip((1.0, reach[0], reach[1]), (1, 1, 1), within[::-1])]):
        edge = centres + side * k * half
        low, high = np.searchsorted(turns, edge - 1e-9), np.searchsorted(turns, edge + 1e-9)
        places[:, j] = low
        for i in np.flatnonzero(high > low):  # points on the edge itself
            inside = int(inner(apart(phase[order[low[i] : high[i]]], centres[i])).sum())
            places[i, j] = low[i] + inside if side > 0 else high[i] - inside
    return order, np.clip(places, first[:, None], first[:, None] + n)


def middle(counts: np.ndarray) -> tuple[int, int, int]:
    """(first, last, below): the ranges that hold the middle ranks, and how many values lie below the first."""
    n, run = int(counts.sum()), np.cumsum(counts)
    if not n:
        return 0, 0, 0
    first, last = (int(np.searchsorted(run, k, side="right")) for k in ((n - 1) // 2, n // 2))
    return first, last, int(run[first] - counts[first])


def deviations(counts: np.ndarray, cuts: np.ndarray, centre: float) -> tuple[float, float]:
    """Bounds of the median distance from a centre, by the values' counts in the ranges between cuts."""
    n = int(counts.sum())
    low, high = np.concatenate([[-np.inf], cuts]), np.concatenate([cuts, [np.inf]])
    near = np.where((low <= centre) & (centre <= high), 0.0, np.minimum(np.abs(low - centre), np.abs(high - centre)))
    far = np.maximum(np.abs(low - centre), np.abs(high - centre))
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    before = np.cumsum(counts[a]) - counts[a]
    return float(near[a][before <= (n - 1) // 2].max()), float(far[b][np.searchsorted(np.cumsum(counts[b]), n // 2, side="right")])


def ranked(values: np.ndarray, n: int, below: int) -> float:
    """The median of n values of which those around the middle are given, and so many lie below them; NaN of none."""
    if not n:
        return float("nan")
    values = np.sort(values)
    return float((values[(n - 1) // 2 - below] + values[n // 2 - below]) / 2)


def box_medians(points: DataFrame, group: list[str], boxes: DataFrame, reach: tuple[float, float], least_in: int, least_side: int, chunk: int = CHUNK) -> DataFrame:
    """(group, centre, low, base, own, n_in, n_side): of each box of ``least_in`` points and ``least_side`` in its shoulders
    (from reach[0] to reach[1] half widths away), the medians inside and in the shoulders, and the median distance from the
    former inside. points: (group, phase, flux); boxes: a row a group (half, centres)."""
    kinds = ", ".join(f"{g} {points.schema[g].dataType.simpleString()}" for g in group)
    there = F.col("phase").isNotNull() & F.col("flux").isNotNull()
    for g in group:
        there = there & F.col(g).isNotNull()
    points = points.filter(there).select(*group, F.col("phase").cast("double"), F.col("flux").cast("double"))
    info = points.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("flux", [i / RANGES for i in range(1, RANGES)], 1000).alias("cuts"))
    info = written(info.join(boxes.filter("half > 0 AND size(centres) > 0").select(*group, "half", "centres"), group).withColumn("chunks", F.ceil(F.col("n") / chunk)), "box-groups")  # a row a group
    dealt = points.join(info.select(*group, "chunks"), group).select(*group, F.pmod(F.xxhash64("phase", "flux"), "chunks").alias("chunk"), "phase", "flux")
    dealt = written(dealt, "box-points")
    by = [*group, "chunk"]

    def over_chunks(wanted: DataFrame, kernel: Callable, fields: str, tag: str) -> DataFrame:
        """kernel(points in order, their ranges, cuts, places of the boxes, the group's row): rows of fields."""
        names = [c.split()[0] for c in fields.split(", ")]

        def run(name, part: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(part) and len(row):
                row = row.iloc[0]
                centres, flux = np.asarray(row["centres"], dtype=float), part["flux"].to_numpy()
                cuts = np.unique(np.asarray(row["cuts"], dtype=float)[:: max(1, -(-RANGES * LEAST_IN_RANGE // int(row["n"])))])
                order, places = slices(part["phase"].to_numpy(), float(row["half"]), centres, reach)
                out = kernel(flux[order], np.searchsorted(cuts, flux, side="right")[order], cuts, places, row)
            return pd.DataFrame([(*name[: len(group)], *r) for r in out], columns=[*group, *names])

        rows = wanted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        met = spread(dealt, *by).groupBy(*by).cogroup(spread(rows, *by).groupBy(*by))
        return written(met.applyInPandas(lambda name, part, row: run(name, part, row), f"{kinds}, {fields}"), tag)

    def each(rows: DataFrame, kernel: Callable, fields: str) -> DataFrame:
        """kernel(rows of one box): a row of fields, or None. A task takes several boxes of a group."""
        names, own = [c.split()[0] for c in fields.split(", ")], [*group, "box"]

        def run(name, part: pd.DataFrame) -> pd.DataFrame:
            found = [(*name[: len(group)], int(box), kernel(some)) for box, some in part.groupby("box")]
            return pd.DataFrame([(*f[:-1], *f[-1]) for f in found if f[-1]], columns=[*own, *names])

        dealt = rows.withColumn("some", F.pmod("box", F.lit(DEALT)))
        return spread(dealt, *group, "some").groupBy(*group, "some").applyInPandas(lambda name, part: run(name, part), f"{kinds}, box int, {fields}")

    def sides(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.concatenate([x[p[0] : p[1]], x[p[4] : p[5]]])

    total = lambda x: np.sum([np.frombuffer(v, dtype=np.int64) for v in x], axis=0)
    values = lambda x: np.concatenate([np.frombuffer(v) for v in x])

    def count(flux, at, cuts, places, row):
        size = len(cuts) + 1
        counts = lambda x: np.bincount(x, minlength=size).astype(np.int64).tobytes()
        return [(i, counts(at[p[2] : p[3]]), counts(sides(at, p))) for i, p in enumerate(places) if p[5] > p[0]]

    def held(part):
        inside, side = total(part["inside"]), total(part["side"])
        if inside.sum() < least_in or side.sum() < least_side:
            return None
        return int(inside.sum()), int(side.sum()), inside.tobytes(), [float(v) for v in (*middle(inside), *middle(side))]

    counted = over_chunks(info, count, "box int, inside binary, side binary", "box-counts")
    counted = written(each(counted, held, "n_in long, n_side long, inside binary, at array<double>"), "box-ranges")
    wanted = info.join(counted.groupBy(*group).agg(F.collect_list(F.concat(F.array(F.col("box").cast("double")), "at")).alias("wanted")), group)

    def give(flux, at, cuts, places, row):
        out = []
        for box, a, b, _, c, d, _ in np.stack(row["wanted"]).astype(np.int64):
            p = places[box]
            f, r = flux[p[2] : p[3]], at[p[2] : p[3]]
            g, s = sides(flux, p), sides(at, p)
            out.append((int(box), f[(r >= a) & (r <= b)].tobytes(), g[(s >= c) & (s <= d)].tobytes()))
        return out

    def medians(part):
        n_in, n_side, at = int(part["n_in"].iloc[0]), int(part["n_side"].iloc[0]), part["at"].iloc[0]
        low, base = ranked(values(part["low"]), n_in, int(at[2])), ranked(values(part["base"]), n_side, int(at[5]))
        cuts = np.unique(np.asarray(part["cuts"].iloc[0], dtype=float)[:: max(1, -(-RANGES * LEAST_IN_RANGE // int(part["n"].iloc[0])))])
        return n_in, n_side, low, base, list(deviations(np.frombuffer(part["inside"].iloc[0], dtype=np.int64), cuts, low))

    given = over_chunks(wanted, give, "box int, low binary, base binary", "box-values")
    # values of a box come together with what is known of it once
    given = given.join(counted, [*group, "box"]).join(info.select(*group, "n", "cuts"), group)
    found = written(each(given, medians, "n_in long, n_side long, low double, base double, between array<double>"), "box-medians")
    wanted = info.join(found.groupBy(*group).agg(F.collect_list(F.concat(F.array(F.col("box").cast("double"), "low"), "between")).alias("wanted")), group)

    def apart(flux, at, cuts, places, row):
        out = []
        for box, low, least, most in np.stack(row["wanted"]):
            p = places[int(box)]
            v = np.abs(flux[p[2] : p[3]] - low)
            out.append((int(box), int((v < least).sum()), v[(v >= least) & (v <= most)].tobytes()))
        return out

    far = over_chunks(wanted, apart, "box int, below long, near binary", "box-distances")
    own = each(far.join(found.select(*group, "box", "n_in"), [*group, "box"]), lambda part: (ranked(values(part["near"]), int(part["n_in"].iloc[0]), int(part["below"].sum())),), "own double")
    out = found.join(own, [*group, "box"]).join(info.select(*group, "centres"), group)
    return out.select(*group, F.get("centres", F.col("box")).alias("centre"), "low", "base", "own", "n_in", "n_side")
