"""Full vetting of keyed series: ordered early exits, a box search for what is left, and gates on its result.

A key's state is its ``status``. Exits come in a fixed order and are decided from one aggregation; only the points of keys
that are still open are written out, in buckets of the key, and every later gate reads that table without an exchange of
its own. Gates are the operators of ``series`` at the limits below.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import scalars as S
from orrery.functions.stats import count_where, draw, median
from orrery.operators import boxes, sampling, series
from orrery.tables import clustered, written

# Limits of the surveyed gates.
PHYSICAL, MOST_DROPPED, LEAST_POINTS = (0.0, 2.5), 0.30, 50
PERIODS, SHORTEST, LONGEST = 15_000, 0.65, 39.8
DURATIONS = tuple(np.geomspace(0.02, 0.5, 10))
DEPTHS, LEAST_SNR, LEAST_IN, BRIGHT, MOST_BRIGHT = (1e-5, 0.95), 10.0, 10, 1.2, 0.02
SEGMENT = {"gap": 1.0, "least": 20, "most_offset": 3.0, "most_ratio": 3.0}
LEAST_DEPTH_RATIO, LEAST_SIGMA, ALIAS_Z, DETECT = 0.5, 7.0, 3.0, 5.0
#: Gates that flag an object, in the order of the surveyed report.
GATES = ["too_few_events", "insufficient_points", "below_noise", "robust_mismatch", "noisy", "inhomogeneous", "depth_too_small", "not_finite", "implausible_depth"]


def vetted(df: DataFrame, key: str, n_periods: int = PERIODS, least_points: int = LEAST_POINTS, parts: int | None = None) -> DataFrame:
    """One row a key of points (key, t, flux, flux_err): status, the best box, every gate, odd and even events, second
    event, ``flagged`` (any gate) and ``passed``.

    status is UNRELIABLE_DATA (over 30 % of the points are finite but unphysical), else TOO_FEW_POINTS (fewer than
    ``least_points`` left), else BASELINE_TOO_SHORT (half the span isn't over the shortest period), else SEARCH_FAILED (no
    box fits), else OK. What a status leaves open is null. gap_suspect is a caution and no gate.

    Null or NaN times and fluxes are no points; missing errors become the key's deviation. Ties in the search go to the
    shortest period. A null key is a key. An empty table gives no rows; other columns are ignored."""
    points = df.select(key, *[F.col(c).cast("double").alias(c) for c in ("t", "flux", "flux_err")])
    t, y = S.clean("t"), S.clean("flux")
    finite = t.isNotNull() & y.isNotNull()
    kept = finite & (y > PHYSICAL[0]) & (y < PHYSICAL[1])
    first = points.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_raw"), count_where(kept).alias("n_points"), count_where(finite & ~kept).alias("n_dropped"), (F.max(F.when(kept, t)) - F.min(F.when(kept, t))).alias("span"),
        F.avg(F.when(kept, (y > BRIGHT).cast("int"))).alias("share_bright"),
    )
    first = first.withColumn("share_dropped", F.col("n_dropped") / F.col("n_raw"))
    top = F.least(F.lit(LONGEST), F.col("span") / 2)
    early = S.ladder((F.col("share_dropped") > MOST_DROPPED, "UNRELIABLE_DATA"), (F.col("n_points") < least_points, "TOO_FEW_POINTS"), (~F.coalesce(top > SHORTEST, F.lit(False)), "BASELINE_TOO_SHORT"))
    first = written(first.withColumn("early", early), "vetting-first")  # a row a key
    open_ = first.filter("early IS NULL").select(F.col(key).alias("__open"))
    rows = points.join(open_, F.col(key).eqNullSafe(F.col("__open")), "left_semi")
    rows = clustered(series.cleaned(rows, [key], low=PHYSICAL[0], high=PHYSICAL[1]), key, "vetting_points", parts)
    search = boxes.box_least_squares(rows, key, n_periods=n_periods, longest=LONGEST, shortest=SHORTEST, durations=DURATIONS).drop("n")
    search = clustered(search.filter("period IS NOT NULL"), key, "vetting_search", parts)
    met = rows.join(search.select(F.col(key).alias("__key"), "period", "t0", "duration"), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    inside = met.groupBy(key).agg(count_where(S.in_event("t", "period", "t0", "duration")).alias("n_in"))
    segment = series.segment_quality(rows, [key], **SEGMENT)
    cover = series.coverage(met, [key])
    robust = series.robust_depth(met, [key]).select(key, F.col("depth").alias("robust_depth"), F.col("sigma").alias("robust_sigma"), F.col("mismatch").alias("too_few_sides"))
    parity = series.odd_even(met, [key], alias_z=ALIAS_Z).select(key, "n_odd", "n_even", "depth_odd", "depth_even", F.col("z").alias("odd_even_z"), "maybe_double")
    second = series.secondary_search(met, [key], detect=DETECT).select(key, "second_phase", F.col("depth").alias("second_depth"), F.col("sigma").alias("second_sigma"), F.col("detected").alias("second_detected"))
    out = first
    for part in (search, inside, segment, cover, robust, parity, second):
        out = out.join(part.withColumnRenamed(key, "__part"), F.col(key).eqNullSafe(F.col("__part")), "left").drop("__part")
    found = F.col("period").isNotNull()
    finite_box = S.clean("depth").isNotNull() & S.clean("depth_err").isNotNull() & S.clean("snr").isNotNull()
    gate = lambda c: F.when(found, F.coalesce(c, F.lit(False)))
    ratio = F.when(F.col("depth") > 0, F.col("robust_depth") / F.col("depth"))
    out = out.withColumns({"depth_ratio": ratio, "status": F.coalesce("early", F.when(found, "OK").otherwise("SEARCH_FAILED"))})
    weak = ~F.coalesce(F.col("depth_ratio") >= LEAST_DEPTH_RATIO, F.lit(False)) | ~F.coalesce(F.col("robust_sigma") >= LEAST_SIGMA, F.lit(False))
    out = out.withColumns({
        "inhomogeneous": F.when(found, F.col("inhomogeneous")), "not_finite": gate(~finite_box), "depth_too_small": gate((F.col("depth") > 0) & (F.col("depth") < DEPTHS[0])),
        "implausible_depth": gate((F.col("depth") > DEPTHS[1]) | (F.col("depth") < 0)), "insufficient_points": gate(F.col("n_in") < LEAST_IN), "below_noise": gate((F.col("snr") < LEAST_SNR) | ~finite_box),
        "noisy": gate(F.col("share_bright") > MOST_BRIGHT), "robust_mismatch": gate(F.coalesce("too_few_sides", F.lit(True)) | weak),
    })
    flagged = F.when(found, F.greatest(*[F.coalesce(F.col(g), F.lit(False)) for g in GATES]))
    out = out.withColumn("flagged", flagged).withColumn("passed", (F.col("status") == "OK") & ~F.coalesce("flagged", F.lit(True)))
    return out.select(
        key, "status", "n_raw", "n_points", "n_dropped", "share_dropped", "span", "n_segments", "max_offset", "max_scatter_ratio", "min_scatter_ratio", "period", "duration", "t0", "depth", "depth_err", "snr", "n_in", "share_bright",
        "n_events", "share_in_near_gap", "share_near_gap", "gap_suspect", "robust_depth", "robust_sigma", "depth_ratio", *GATES, "n_odd", "n_even", "depth_odd", "depth_even", "odd_even_z", "maybe_double", "second_phase",
        "second_depth", "second_sigma", F.when(found, F.coalesce("second_detected", F.lit(False))).alias("second_detected"), "flagged", "passed",
    )


# -- injection loop ---------------------------------------------------------------------------------------------------

# The prior of injected events and the match of periods.
PRIOR_PERIOD, PRIOR_DEPTH, PRIOR_MASS, PRIOR_RADII, PRIOR_IMPACT = (0.65, 39.8), (0.002, 0.5), (0.8, 3.0), (0.8, 3.0), (0.0, 0.9)
PRIOR_INGRESS, SECOND_SHARE, SECOND_RATIO, TOLERANCE, BLOCK_DAYS = (0.2, 1.0), 0.5, (0.1, 1.0), 0.02, 1.0
KEPLER = 4.2084  # solar radii of one solar mass at one day


def drawn_injections(hosts: DataFrame, key: str, per_host: int, seed) -> DataFrame:
    """(key, k, period, depth, depth2, duration, ingress, t0_share): events of the prior, per_host for each host. The sum
    of radii is drawn below nine tenths of the separation (half of it where no such sum exists)."""
    rows = hosts.select(key).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(per_host - 1))))
    u = lambda name: draw(f"{seed}-{name}", key, "k")
    flat = lambda name, lo, hi: lo + (hi - lo) * u(name)
    curved = lambda name, lo, hi: lo * F.pow(F.lit(hi / lo), u(name))
    rows = rows.withColumns({"period": curved("period", *PRIOR_PERIOD), "depth": curved("depth", *PRIOR_DEPTH), "b": flat("impact", *PRIOR_IMPACT)})
    rows = rows.withColumn("a", KEPLER * F.pow(flat("mass", *PRIOR_MASS) * F.col("period") * F.col("period"), 1 / 3))
    widest = F.least(F.lit(PRIOR_RADII[1]), 0.9 * F.col("a"))
    radii = F.when(widest > PRIOR_RADII[0], PRIOR_RADII[0] + (widest - PRIOR_RADII[0]) * u("radii")).otherwise(0.5 * F.col("a"))
    duration = F.col("period") / np.pi * F.asin(F.least(F.lit(1.0), radii / F.col("a") * F.sqrt(F.greatest(F.lit(1e-6), 1 - F.col("b") * F.col("b")))))
    second = F.when(u("second") < SECOND_SHARE, F.col("depth") * flat("ratio", *SECOND_RATIO)).otherwise(0.0)
    return rows.select(key, "k", "period", "depth", second.alias("depth2"), duration.alias("duration"), flat("ingress", *PRIOR_INGRESS).alias("ingress"), u("t0").alias("t0_share"))


def injection_trials(points: DataFrame, hosts: DataFrame, key: str, n_injected: int, n_shuffled: int, seed) -> tuple[DataFrame, DataFrame]:
    """Series of trials and their truth. Each host's points are read once: those of (key, trial) with events put in
    (kind inject) or in day-long blocks of random order (kind shuffle). Truth is a row a trial."""
    own = written(points.join(hosts.select(F.col(key).alias("__h")), F.col(key) == F.col("__h"), "left_semi").select(key, "t", "flux", "flux_err"), "injection-points")
    w = Window.partitionBy(key).orderBy("t", "flux")
    step = own.withColumn("__d", F.lead("t").over(w) - F.col("t")).groupBy(key).agg(F.min("t").alias("start"), (F.max("t") - F.min("t")).alias("span"), median("__d").alias("cadence"), F.count(F.lit(1)).alias("n_points"))
    truth = drawn_injections(hosts, key, n_injected, seed).join(step, key)
    truth = truth.select(key, F.lit("inject").alias("kind"), "k", "period", (F.col("start") + F.col("t0_share") * F.col("period")).alias("t0"), "depth", "depth2", "duration", "ingress", (F.col("period") <= F.col("span") / 2).alias("searchable"), "span", "cadence")
    model = S.trapezoid("t", "period", "t0", "duration", "ingress", "depth", "depth2")
    injected = own.join(truth, key).select(key, "kind", "k", "t", (F.col("flux") * (1 - model)).alias("flux"), "flux_err")
    none = F.lit(None).cast("double")
    nulls = step.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_shuffled - 1))))
    null_truth = nulls.select(key, F.lit("shuffle").alias("kind"), "k", *[none.alias(c) for c in ("period", "t0", "depth", "depth2", "duration", "ingress")], F.lit(True).alias("searchable"), "span", "cadence")
    # runs of points that span a day, five at least; each trial puts them in an order of its own
    run = F.greatest(F.lit(5.0), F.rint(BLOCK_DAYS / F.col("cadence")))
    each = own.join(nulls.select(key, "k", run.alias("run")), key)
    trial = Window.partitionBy(key, "k")
    ranked = each.withColumn("n", F.row_number().over(trial.orderBy("t", "flux")) - 1)
    moved = ranked.withColumn("block", F.floor(F.col("n") / F.col("run"))).withColumn("place", draw(f"{seed}-shuffle", key, "k", "block"))
    moved = moved.withColumn("n", F.row_number().over(trial.orderBy("place", "block", "n")) - 1).select(key, "k", "n", F.col("flux").alias("moved"))
    shuffled = ranked.join(moved, [key, "k", "n"]).select(key, F.lit("shuffle").alias("kind"), "k", "t", F.col("moved").alias("flux"), "flux_err")
    return injected.unionByName(shuffled), truth.unionByName(null_truth)


def injection_results(points: DataFrame, hosts: DataFrame, key: str, n_injected: int = 6, n_shuffled: int = 2, seed=20261108, done: DataFrame | None = None, n_periods: int = PERIODS, least_points: int = LEAST_POINTS) -> DataFrame:
    """A row a trial: its truth, how the same vetting as ever judges it, and the outcome: missed, exact, alias or wrong for
    injected events, pass or clean for shuffled ones. Trials of ``done`` (key, kind, k) are not run again; a trial whose
    vetting ends early is a row with that status, and never stops the others."""
    # read many times from here on: hosts that follow from a vetting, and the trials, would each be worked out anew
    hosts = written(hosts.select(key), "injection-hosts")
    series_, truth = injection_trials(points, hosts, key, n_injected, n_shuffled, seed)
    truth = written(truth, "injection-truth")
    if done is not None:
        gone = done.select(key, "kind", "k")
        series_, truth = series_.join(gone, [key, "kind", "k"], "left_anti"), truth.join(gone, [key, "kind", "k"], "left_anti")
    name = F.concat_ws("|", "kind", F.col("k").cast("string"), F.col(key).cast("string"))
    series_ = written(series_, "injection-trials")
    judged = vetted(series_.withColumn("__trial", name), "__trial", n_periods, least_points).select("__trial", "status", F.col("period").alias("found"), "snr", "n_events", *GATES, "passed")
    out = truth.withColumn("__trial", name).join(judged, "__trial", "left").drop("__trial")
    out = out.withColumns({"status": F.coalesce("status", F.lit("NOT_RUN")), "passed": F.coalesce("passed", F.lit(False))})
    shuffled = F.when(F.col("passed"), "pass").otherwise("clean")
    return out.withColumn("outcome", F.when(F.col("kind") == "shuffle", shuffled).otherwise(S.outcome("passed", "found", "period", TOLERANCE)))


def injection_hosts(judged: DataFrame, key: str, x: str, strata: int, n: int, seed) -> DataFrame:
    """Hosts: keys whose own series is usable and fails the gates, drawn over quantile strata of x."""
    return sampling.stratified(judged.filter((F.col("status") == "OK") & ~F.col("passed")), key, x, strata, n, seed)
