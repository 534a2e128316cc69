"""Operators on long tables of irregular series: one row a point, keyed by object (and segment).

Everything is a composition of aggregates and windows over one partitioning by key. ``key`` is a list of columns; ``t``
is a time in days, ``y`` a relative flux. Ephemerides (period, t0, duration) are columns of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import scalars as S
from orrery.functions.stats import MAD_SCALE, count_where, median, median_where, robust

HALF_PI_ROOT = 1.2533141373155003  # of pi / 2


def cleaned(df: DataFrame, key: list[str], t="t", y="flux", err="flux_err", low=0.0, high=2.5) -> DataFrame:
    """Finite points of physical flux; errors that are missing or not positive become the key's deviation, else 1e-6."""
    rows = df.withColumns({t: S.clean(t), y: S.clean(y), err: S.clean(err)}).filter(F.col(t).isNotNull() & (F.col(y) > low) & (F.col(y) < high))
    sd = F.stddev_pop(y).over(Window.partitionBy(*key))
    return rows.withColumn(err, F.when(F.col(err) > 0, F.col(err)).otherwise(F.when(sd > 0, sd).otherwise(1e-6)))


def dropped(df: DataFrame, key: list[str], y="flux", low=0.0, high=2.5) -> DataFrame:
    """Per key: points, finite points out of the physical range, and a gate on bright outliers (share over 1.2)."""
    v = S.clean(y)
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), count_where((v <= low) | (v >= high)).alias("n_unphysical"), F.avg((v > 1.2).cast("int")).alias("share_bright")
    )


def normalised(df: DataFrame, key: list[str], y: str, out: str = "flux") -> DataFrame:
    """y over its median of the key."""
    return df.withColumn(out, F.col(y) / median(y).over(Window.partitionBy(*key)))


def relative_flux(df: DataFrame, key: list[str], band: str, mag="mag", err="magerr", flags="catflags", least=1) -> DataFrame:
    """Unflagged photometry as flux over each band's median; bright outliers beyond five robust deviations are clipped."""
    good = df.filter((F.col(flags) == 0) & (F.col(err) > 0) & (F.col(err) <= 0.2))
    w = Window.partitionBy(*key, band)
    flux = S.flux_ratio(F.col(mag) - median(mag).over(w))
    rel = good.withColumns({"flux": flux, "__n": F.count(F.lit(1)).over(w)}).filter(F.col("__n") >= least).drop("__n")
    rel = rel.withColumn("flux_err", F.col("flux") * F.col(err) / 1.0857)
    sigma = robust(rel, key, "flux").select(*key, (MAD_SCALE * F.col("mad")).alias("__s"))
    return rel.join(sigma, key).filter(F.col("flux") < 1 + F.greatest(5 * F.col("__s"), F.lit(0.05))).drop("__s")


def segments(df: DataFrame, key: list[str], t="t", gap=1.0, out="segment") -> DataFrame:
    """Number the stretches between gaps, from 0."""
    w = Window.partitionBy(*key).orderBy(t)
    new = F.when(F.col(t) - F.lag(t).over(w) > gap, 1).otherwise(0)
    return df.withColumn(out, F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def segment_quality(df: DataFrame, key: list[str], t="t", y="flux", gap=1.0, least=50, most_offset=5.0, most_ratio=5.0) -> DataFrame:
    """Per key: segments of enough points, their greatest offset from the whole in its robust deviation, the greatest and
    least scatter over the median scatter, and whether any is out of bounds. Null where there are fewer than two."""
    parts = segments(df, key, t, gap)
    scale = lambda r: F.when(F.col("mad") > 0, MAD_SCALE * F.col("mad")).otherwise(F.col("sd"))
    whole = robust(df, key, y)
    whole = whole.select(*key, F.col("med").alias("g_med"), F.when(scale(0) > 0, scale(0)).otherwise(1e-6).alias("g_sigma"))
    each = robust(parts, [*key, "segment"], y).filter(F.col("n") >= least).withColumn("s", scale(0)).join(whole, key)
    positive = median_where("s", F.col("s") > 0)
    got = each.groupBy(*key).agg(F.count(F.lit(1)).alias("n_segments"), F.max(F.abs(F.col("med") - F.col("g_med")) / F.col("g_sigma")).alias("offset"), F.max("s").alias("hi"), F.min("s").alias("lo"), positive.alias("mid"))
    some = F.col("n_segments") >= 2
    ratio = lambda c: F.when(some, F.when(F.col("mid") > 0, F.col(c) / F.col("mid")).otherwise(1.0))
    out = got.select(*key, "n_segments", F.when(some, F.col("offset")).alias("max_offset"), ratio("hi").alias("max_scatter_ratio"), ratio("lo").alias("min_scatter_ratio"))
    flag = (F.col("max_offset") > most_offset) | (F.col("max_scatter_ratio") > most_ratio) | (F.col("min_scatter_ratio") < 1 / most_ratio)
    everyone = df.select(*key).distinct().join(out, key, "left").withColumn("n_segments", F.coalesce("n_segments", F.lit(0).cast("long")))
    return everyone.withColumn("inhomogeneous", F.coalesce(flag, F.lit(False)))


def coverage(df: DataFrame, key: list[str], t="t", least_points=3, least_events=3, gap=0.5, near=0.5, share=0.3, chance=3.0) -> DataFrame:
    """Per key: events seen with enough points, shares of points near a gap's edge inside events and overall, and flags."""
    w = Window.partitionBy(*key).orderBy(t)
    x = F.col(t)
    edge = (x - F.lag(t).over(w) > gap) | (F.lead(t).over(w) - x > gap)
    marked = df.withColumns({"__in": S.in_event(t, "period", "t0", "duration"), "__e": S.epoch(t, "period", "t0"), "__edge": F.when(F.coalesce(edge, F.lit(False)), x)})
    last = F.last("__edge", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # backwards, as a frame that ends with the key is gone through anew for each row
    nxt = F.min("__edge").over(Window.partitionBy(*key).orderBy(F.desc(t)).rangeBetween(Window.unboundedPreceding, 0))
    close = F.coalesce(F.least(x - last, nxt - x) < near, F.lit(False))
    marked = marked.withColumn("__close", close)
    per = marked.groupBy(*key, "__e").agg(count_where("__in").alias("n_in"), count_where(F.col("__in") & F.col("__close")).alias("in_close"), count_where("__close").alias("close"), F.count(F.lit(1)).alias("n"))
    got = per.groupBy(*key).agg(count_where(F.col("n_in") >= least_points).alias("n_events"), F.sum("n_in").alias("a"), F.sum("in_close").alias("b"), F.sum("close").alias("c"), F.sum("n").alias("d"))
    f_in, f_all = F.coalesce(F.try_divide("b", "a"), F.lit(0.0)), F.coalesce(F.try_divide("c", "d"), F.lit(0.0))
    out = got.select(*key, "n_events", f_in.alias("share_in_near_gap"), f_all.alias("share_near_gap"))
    return out.withColumns({"too_few_events": F.col("n_events") < least_events, "gap_suspect": (F.col("share_in_near_gap") > share) & (F.col("share_in_near_gap") > chance * F.col("share_near_gap"))})


def robust_depth(df: DataFrame, key: list[str], t="t", y="flux") -> DataFrame:
    """Per key: median outside minus median inside events, and its significance; null with fewer than three points on
    either side, or without scatter."""
    inside = S.in_event(t, "period", "t0", "duration")
    first = df.withColumn("__in", inside)
    mid = first.groupBy(*key).agg(median_where(y, ~F.col("__in")).alias("out"), median_where(y, F.col("__in")).alias("in"), count_where("__in").alias("n_in"), count_where(~F.col("__in")).alias("n_out"))
    spread = first.filter("NOT __in").join(mid.select(*key, "out"), key).groupBy(*key).agg((MAD_SCALE * median(F.abs(F.col(y) - F.col("out")))).alias("mad"))
    both = mid.join(spread, key, "left")
    enough = (F.col("n_in") >= 3) & (F.col("n_out") >= 3)
    depth = F.when(enough, F.col("out") - F.col("in"))
    error = F.when(enough & (F.col("mad") > 0), F.col("mad") * HALF_PI_ROOT / F.sqrt(F.greatest("n_in", F.lit(1))))
    return both.select(*key, "n_in", "n_out", depth.alias("depth"), (depth / error).alias("sigma"), (~enough).alias("mismatch"))


def odd_even(df: DataFrame, key: list[str], t="t", y="flux", alias_z=3.0) -> DataFrame:
    """Per key: depth of odd and even events, their difference in sigmas, and whether the period may be doubled."""
    inside, odd = S.in_event(t, "period", "t0", "duration", 1.2), S.is_odd(S.epoch(t, "period", "t0"))
    m = df.withColumns({"__in": inside, "__odd": odd}).groupBy(*key).agg(
        median_where(y, ~F.col("__in")).alias("base"), F.stddev_pop(F.when(~F.col("__in"), F.col(y))).alias("sd"), count_where(~F.col("__in")).alias("n_out"),
        *[f(c).alias(n) for c, tag in ((F.col("__in") & F.col("__odd"), "odd"), (F.col("__in") & ~F.col("__odd"), "even")) for f, n in ((lambda c: median_where(y, c), f"m_{tag}"), (count_where, f"n_{tag}"))],
    )
    ok = (F.col("n_out") >= 10) & (F.col("n_odd") >= 3) & (F.col("n_even") >= 3)
    a, b = F.col("base") - F.col("m_odd"), F.col("base") - F.col("m_even")
    z = F.abs(a - b) / (F.col("sd") * F.sqrt(1 / F.col("n_odd") + 1 / F.col("n_even")))
    out = m.select(*key, "n_odd", "n_even", F.when(ok, a).alias("depth_odd"), F.when(ok, b).alias("depth_even"), F.when(ok & (F.col("sd") > 0), z).alias("z"))
    return out.withColumn("maybe_double", F.coalesce(F.col("z") > alias_z, F.lit(False)))


def odd_even_weighted(df: DataFrame, key: list[str], t="t", y="flux", err="flux_err") -> DataFrame:
    """Per key: inverse-variance mean flux of odd and even events and their difference in sigmas."""
    w = 1 / F.pow(F.col(err), 2)
    inside, odd = S.in_event(t, "period", "t0", "duration"), S.is_odd(S.epoch(t, "period", "t0"))
    pick = lambda v, o: F.sum(F.when(F.col("__in") & (F.col("__odd") == o), v))
    m = df.withColumns({"__in": inside, "__odd": odd}).groupBy(*key).agg(pick(w * F.col(y), True).alias("a"), pick(w, True).alias("wa"), pick(w * F.col(y), False).alias("b"), pick(w, False).alias("wb"))
    a, b = F.col("a") / F.col("wa"), F.col("b") / F.col("wb")
    return m.select(*key, a.alias("odd"), b.alias("even"), ((a - b) / F.sqrt(1 / F.col("wa") + 1 / F.col("wb"))).alias("z"))


def secondary_search(df: DataFrame, key: list[str], t="t", y="flux", bins=100, least=5, least_bins=10, detect=3.0, most_ppt=500.0) -> DataFrame:
    """Per key: the deepest phase bin away from the main event, against the scatter of the bins."""
    f = S.phase(t, "period", "t0")
    away = F.abs(f) >= F.col("duration") / F.col("period")
    binned = df.filter(away).withColumn("bin", F.floor((f + 0.5) * bins)).groupBy(*key, "bin").agg(median(y).alias("m"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    got = binned.groupBy(*key).agg(F.count(F.lit(1)).alias("n_bins"), F.stddev_pop("m").alias("sd"), median("m").alias("mid"), F.min("m").alias("low"), F.min_by("bin", F.struct("m", "bin")).alias("at"))
    got = got.filter(F.col("n_bins") >= least_bins)
    depth = F.col("mid") - F.col("low")
    out = got.select(*key, "n_bins", ((F.col("at") + 0.5) / bins - 0.5).alias("second_phase"), depth.alias("depth"), F.when(F.col("sd") > 0, depth / F.col("sd")).otherwise(0.0).alias("sigma"))
    return out.withColumn("detected", (F.col("sigma") > detect) & (F.abs(F.col("depth")) * 1000 <= most_ppt))


def depth_at(df: DataFrame, key: list[str], centre=0.0, t="t", y="flux", core=0.5, outside=1.5) -> DataFrame:
    """Per key: median flux away from a phase minus median in its core; widths in durations."""
    d, width = S.circular(S.phase(t, "period", "t0") - S.col(centre)), F.col("duration") / F.col("period")
    return df.withColumns({"__d": d, "__w": width}).groupBy(*key).agg(
        (median_where(y, F.col("__d") > outside * F.col("__w") / 2) - median_where(y, F.col("__d") < core * F.col("__w") / 2)).alias("depth"), count_where(F.col("__d") < core * F.col("__w") / 2).alias("n_core")
    )


def core_against_quadrature(df: DataFrame, key: list[str], t="t", y="flux") -> DataFrame:
    """Per key: median near phases -1/4 and 1/4 minus median in the core of the event."""
    f, half = S.phase(t, "period", "t0"), F.col("duration") / F.col("period") / 2
    quad = F.abs(F.abs(F.col("__f")) - 0.25) < F.greatest(F.col("__h"), F.lit(0.05))
    return df.withColumns({"__f": f, "__h": half}).groupBy(*key).agg((median_where(y, quad) - median_where(y, F.abs(F.col("__f")) < 0.5 * F.col("__h"))).alias("dip"))


def cadence(df: DataFrame, key: list[str], t="t") -> DataFrame:
    """Per key: the median step between points."""
    w = Window.partitionBy(*key).orderBy(t)
    return df.withColumn("__d", F.lead(t).over(w) - F.col(t)).groupBy(*key).agg(median("__d").alias("cadence"))


def per_event(df: DataFrame, key: list[str], t="t", y="flux", least_in=2, least_out=4) -> DataFrame:
    """(key, epoch): depth of each event against the flux within one and a half durations around it, and its error."""
    x = F.abs(F.col(t) - F.col("t0") - S.epoch(t, "period", "t0") * F.col("period"))
    near = df.withColumns({"epoch": S.epoch(t, "period", "t0"), "__x": x}).filter(F.col("__x") < 1.5 * F.col("duration"))
    inside = F.col("__x") < F.col("duration") / 4
    side = F.col("__x") > F.col("duration") / 2
    got = near.groupBy(*key, "epoch").agg(
        median_where(y, side).alias("base"), median_where(y, inside).alias("low"), F.stddev_samp(F.when(side, F.col(y))).alias("sd"), count_where(inside).alias("n_in"), count_where(side).alias("n_out")
    )
    return got.filter((F.col("n_in") >= least_in) & (F.col("n_out") >= least_out)).select(*key, "epoch", (F.col("base") - F.col("low")).alias("depth"), (F.col("sd") / F.sqrt("n_in")).alias("depth_err"), "n_in", "n_out")


def event_floors(df: DataFrame, key: list[str], t="t", core=0.35, fine=0.05) -> DataFrame:
    """(key, least_core, least_local): how many points an event needs, 60 % of those its windows can hold at the key's
    cadence (the median of its steps below ``fine``, else of all), within 3 to 5 and 6 to 10; 5 and 10 without a cadence."""
    w = Window.partitionBy(*key).orderBy(t)
    steps = df.withColumn("__d", F.lead(t).over(w) - F.col(t))
    per = steps.groupBy(*key).agg(F.coalesce(median_where("__d", F.col("__d") < fine), median("__d")).alias("cadence"), F.first("duration").alias("duration"))
    floor = lambda width, lo, hi: F.when(F.col("cadence") > 0, F.least(F.greatest(F.rint(0.6 * width * F.col("duration") / F.col("cadence")), F.lit(float(lo))), F.lit(float(hi)))).otherwise(F.lit(float(hi))).cast("int")
    return per.select(*key, floor(2 * core, 3, 5).alias("least_core"), floor(4, 6, 10).alias("least_local"))


def event_depths(df: DataFrame, key: list[str], t="t", y="flux", core=0.35, least_sigma=5.0) -> DataFrame:
    """(key, epoch): t_mid, depth, err, sigma and seen of each event that has enough points by ``event_floors``: the
    median within ``core`` durations against that of its surroundings, one to three durations away.

    A point near two events counts for both. err (from the surroundings' scaled MAD) and sigma are null without scatter,
    and seen is then false. Null times or fluxes are ignored; an empty table gives no rows."""
    df = df.filter(F.col(t).isNotNull() & F.col(y).isNotNull())
    reach = lambda sign: (F.col(t) - F.col("t0") + sign * 3 * F.col("duration")) / F.col("period")
    met = df.filter(F.floor(reach(1)) >= F.ceil(reach(-1))).withColumn("epoch", F.explode(F.sequence(F.ceil(reach(-1)), F.floor(reach(1)))))
    met = met.withColumns({"t_mid": F.col("t0") + F.col("epoch") * F.col("period")}).withColumn("__x", F.abs(F.col(t) - F.col("t_mid")) / F.col("duration"))
    inside, side = F.col("__x") < core, (F.col("__x") > 1) & (F.col("__x") < 3)
    event = [*key, "epoch"]
    got = met.groupBy(*event).agg(F.first("t_mid").alias("t_mid"), median_where(y, side).alias("base"), median_where(y, inside).alias("low"), count_where(inside).alias("n_core"), count_where(side).alias("n_local"))
    got = got.join(event_floors(df, key, t, core), key).filter((F.col("n_core") >= F.col("least_core")) & (F.col("n_local") >= F.col("least_local")))
    spread = met.filter(side).join(got.select(*event, "base"), event).groupBy(*event).agg((MAD_SCALE * median(F.abs(F.col(y) - F.col("base")))).alias("mad"))
    depth = (F.col("base") - F.col("low")) / F.col("base")
    err = F.when(F.col("mad") > 0, F.col("mad") * HALF_PI_ROOT / F.sqrt("n_core") / F.col("base"))
    found = got.join(spread, event).select(*event, "t_mid", depth.alias("depth"), err.alias("err"))
    sigma = F.when(F.col("err") > 0, F.col("depth") / F.col("err"))
    return found.withColumn("sigma", sigma).withColumn("seen", F.coalesce(F.col("sigma") >= least_sigma, F.lit(False)))


def pooled_events(events: DataFrame, key: list[str]) -> DataFrame:
    """Per key: median depth of the events; its error from their errors or their scatter, whichever is larger."""
    m = events.groupBy(*key).agg(median("depth").alias("pooled"), median("depth_err").alias("e"), F.stddev_samp("depth").alias("sd"), F.count(F.lit(1)).alias("n_events"))
    return m.select(*key, "n_events", "pooled", F.greatest(F.col("e") / F.sqrt("n_events"), F.col("sd") / F.sqrt("n_events")).alias("pooled_err"))


def absent_events(events: DataFrame, pooled: DataFrame, key: list[str]) -> DataFrame:
    """Add absent: shallower than half the pooled depth, and by over five errors."""
    low = (F.col("depth") < F.col("pooled") / 2) & ((F.col("pooled") - F.col("depth")) > 5 * F.col("depth_err"))
    return events.join(pooled.select(*key, "pooled"), key).withColumn("absent", F.coalesce(low, F.lit(False)))


def circular_gap(df: DataFrame, key: list[str], multipliers=(0.5, 1.0, 2.0), t="t") -> DataFrame:
    """Per key and period multiplier: the least arc between neighbouring phases, the wrap included, and the chance that n
    random phases have one as small: 1 - (1 - n g)^(n - 1)."""
    each = df.withColumn("multiplier", F.explode(F.array(*map(F.lit, multipliers)))).withColumn("__f", S.phase(t, F.col("period") * F.col("multiplier"), "t0"))
    w = Window.partitionBy(*key, "multiplier").orderBy("__f")
    whole = Window.partitionBy(*key, "multiplier")
    arc = F.coalesce(F.lead("__f").over(w), F.min("__f").over(whole) + 1) - F.col("__f")
    got = each.withColumn("__g", arc).groupBy(*key, "multiplier").agg(F.count(F.lit(1)).alias("n"), F.min("__g").alias("gap"))
    return got.withColumn("p", F.when(F.col("n") >= 2, 1 - F.pow(F.greatest(1 - F.col("n") * F.col("gap"), F.lit(0.0)), F.col("n") - 1)))


def sessions(df: DataFrame, key: list[str], t="t", x="oc", gap=12.0, clip=4.0, least=3) -> DataFrame:
    """Per stretch between gaps: clipped mean of x, its standard error and the points kept."""
    parts = segments(df, key, t, gap)
    by = [*key, "segment"]
    r = robust(parts, by, x).select(*by, "med", (MAD_SCALE * F.col("mad") + 1e-6).alias("s"), F.col("n").alias("n_all"))
    kept = parts.join(r, by).filter((F.col("n_all") >= least) & (F.abs(F.col(x) - F.col("med")) < clip * F.col("s")))
    return kept.groupBy(*by).agg(F.avg(t).alias("t_mean"), F.avg(x).alias("x_mean"), (F.stddev_samp(x) / F.sqrt(F.count(F.lit(1)))).alias("x_err"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _micros(t: str) -> Column:
    return F.rint(F.col(t) * S.DAY_MICROS).cast("long")


def rolling_median(df: DataFrame, key: list[str], width_days: float, t="t", y="flux", least=1, out="trend", where: Column | None = None) -> DataFrame:
    """Median over a centred time window, open on the left and closed on the right; where leaves points out."""
    half = int(width_days / 2 * S.DAY_MICROS)
    w = Window.partitionBy(*key).orderBy("__us").rangeBetween(-half + 1, half)
    v = F.col(y) if where is None else F.when(where, F.col(y))
    done = df.withColumn("__us", _micros(t)).withColumn(out, F.when(F.count(v).over(w) >= least, F.percentile(v, 0.5).over(w)))
    return done.drop("__us")


def filled(df: DataFrame, key: list[str], x: str, t="t") -> DataFrame:
    """x with its nulls interpolated in time between neighbours, and constant beyond them."""
    w = Window.partitionBy(*key).orderBy(t)
    point = F.when(F.col(x).isNotNull(), F.struct(F.col(t).alias("t"), F.col(x).alias("x")))
    back = Window.partitionBy(*key).orderBy(F.desc(t)).rangeBetween(Window.unboundedPreceding, 0)  # not forwards: see coverage
    rows = df.withColumns({"__a": F.last(point, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "__b": F.min(point).over(back)})
    a, b = F.col("__a"), F.col("__b")
    line = a["x"] + (b["x"] - a["x"]) * F.coalesce(F.try_divide(F.col(t) - a["t"], b["t"] - a["t"]), F.lit(0.0))
    return rows.withColumn(x, F.coalesce(x, line, a["x"], b["x"])).drop("__a", "__b")


def detrended(df: DataFrame, key: list[str], width_days: float, t="t", y="flux", least=1, widths=1.5, second_phase=None) -> DataFrame:
    """Flux over a rolling median that leaves out events (both, if the second's phase is given)."""
    f, half = S.phase(t, "period", "t0"), F.col("duration") / F.col("period") / 2 * widths
    away = S.circular(f) >= half
    if second_phase is not None:
        away = away & (S.circular(f - S.col(second_phase)) >= half)
    trend = filled(rolling_median(df, key, width_days, t, y, least, "trend", away), key, "trend", t)
    return trend.withColumn("flat", F.col(y) / F.col("trend"))


def rolling_rows(df: DataFrame, key: list[str], points: int, t="t", y="flux", least=1, out="smooth") -> DataFrame:
    """Median over a centred window of points."""
    h = points // 2
    w = Window.partitionBy(*key).orderBy(t).rowsBetween(-h, h)
    return df.withColumn(out, F.when(F.count(y).over(w) >= least, F.percentile(y, 0.5).over(w)))


def spikes(df: DataFrame, key: list[str], t="t", y="flux", sigmas=5.0) -> DataFrame:
    """Add spike: a point far off the line between its neighbours, in robust deviations of such distances."""
    w = Window.partitionBy(*key).orderBy(t)
    ta, tb, ya, yb = F.lag(t).over(w), F.lead(t).over(w), F.lag(y).over(w), F.lead(y).over(w)
    off = F.col(y) - (ya + (yb - ya) * (F.col(t) - ta) / F.nullif(tb - ta, F.lit(0.0)))
    rows = df.withColumn("__off", off)
    scale = robust(rows, key, "__off").select(*key, (MAD_SCALE * F.col("mad")).alias("__s"), F.col("med").alias("__m"))
    return rows.join(scale, key).withColumn("spike", F.coalesce(F.abs(F.col("__off") - F.col("__m")) > sigmas * F.col("__s"), F.lit(False))).drop("__off", "__s", "__m")


def clip_groups(df: DataFrame, by: list[str], y="flux", sigmas=4.0) -> DataFrame:
    """Rows within so many robust deviations of their group's median."""
    r = robust(df, by, y).select(*by, F.col("med").alias("__m"), (MAD_SCALE * F.col("mad")).alias("__s"))
    return df.join(r, by).filter((F.col("__s") == 0) | (F.abs(F.col(y) - F.col("__m")) <= sigmas * F.col("__s"))).drop("__m", "__s")


def flares(df: DataFrame, key: list[str], t="t", y="flux", points=15, sigmas=3.0, least_run=3, sign=1) -> DataFrame:
    """Runs of at least so many consecutive points beyond so many robust deviations of the smoothed series."""
    rest = rolling_rows(df, key, points, t, y).withColumn("__r", sign * (F.col(y) - F.col("smooth")))
    scale = robust(rest, key, "__r").select(*key, F.col("med").alias("__m"), (MAD_SCALE * F.col("mad")).alias("__s"))
    w = Window.partitionBy(*key).orderBy(t)
    z = rest.join(scale, key).filter("__s > 0").withColumn("z", (F.col("__r") - F.col("__m")) / F.col("__s")).withColumn("__n", F.row_number().over(w))
    high = z.filter(F.col("z") > sigmas)
    runs = high.withColumn("__g", F.col("__n") - F.row_number().over(w))
    got = runs.groupBy(*key, "__g").agg(F.min(t).alias("start"), F.max(t).alias("stop"), F.count(F.lit(1)).alias("n"), F.max_by(t, F.struct("z", t)).alias("peak_t"), F.max("z").alias("peak_z"))
    return got.filter(F.col("n") >= least_run).drop("__g")


def point_scatter(df: DataFrame, key: list[str], t="t", y="flux") -> DataFrame:
    """Per key: robust deviation of neighbouring differences over the root of two."""
    w = Window.partitionBy(*key).orderBy(t)
    steps = df.withColumn("__d", F.lead(y).over(w) - F.col(y)).filter("__d IS NOT NULL")
    return robust(steps, key, "__d").select(*key, (MAD_SCALE * F.col("mad") / F.sqrt(F.lit(2.0))).alias("scatter"), F.col("n").alias("n_steps"))


def running_integral(df: DataFrame, key: list[str], t="t", y="flux", out="integral") -> DataFrame:
    """Cumulative trapezoid rule."""
    w = Window.partitionBy(*key).orderBy(t)
    area = 0.5 * (F.col(y) + F.lag(y).over(w)) * (F.col(t) - F.lag(t).over(w))
    return df.withColumn("__a", F.coalesce(area, F.lit(0.0))).withColumn(out, F.sum("__a").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__a")


def split_halves(df: DataFrame, key: list[str], part: str, t="t") -> DataFrame:
    """Add half: alternating parts where a key has several, else alternating cycles."""
    w = Window.partitionBy(*key)
    rank = F.dense_rank().over(w.orderBy(part))
    several = F.max(part).over(w) != F.min(part).over(w)
    return df.withColumn("half", F.when(several, F.pmod(rank - 1, F.lit(2))).otherwise(F.pmod(S.epoch(t, "period", "t0"), F.lit(2)).cast("int")).cast("int"))


def alternation(events: DataFrame, key: list[str], x="oc", n="epoch") -> DataFrame:
    """Per key: median of x in even minus odd cycles, and its significance."""
    odd = S.is_odd(n)
    m = events.withColumn("__o", odd).groupBy(*key).agg(median_where(x, ~F.col("__o")).alias("even"), median_where(x, F.col("__o")).alias("odd"), count_where("__o").alias("n_odd"), count_where(~F.col("__o")).alias("n_even"))
    rest = events.withColumn("__o", odd).join(m, key).withColumn("__r", F.abs(F.col(x) - F.when(F.col("__o"), F.col("odd")).otherwise(F.col("even"))))
    sd = rest.groupBy(*key).agg((MAD_SCALE * median("__r")).alias("sd"))
    d = F.col("even") - F.col("odd")
    return m.join(sd, key).select(*key, "n_even", "n_odd", d.alias("difference"), F.when((F.col("sd") > 0) & (F.col("n_odd") > 0) & (F.col("n_even") > 0), F.abs(d) / (F.col("sd") * F.sqrt(1 / F.col("n_odd") + 1 / F.col("n_even")))).alias("z"))


def phase_bins(df: DataFrame, key: list[str], bins=50, t="t", y="flux", least=2) -> DataFrame:
    """(key, bin): centre and median of folded points, bins of enough points only."""
    b = F.floor((S.phase(t, "period", "t0") + 0.5) * bins)
    got = df.withColumn("bin", b).groupBy(*key, "bin").agg(median(y).alias("flux"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return got.withColumn("centre", (F.col("bin") + 0.5) / bins - 0.5)


def edge_bins(df: DataFrame, key: list[str], x, y: str, edges: Column, least=3) -> DataFrame:
    """(key, bin): median of y between given edges, [a, b)."""
    n = F.size(F.filter(edges, lambda e: e <= S.col(x)))
    rows = df.withColumns({"bin": n, "__k": F.size(edges)}).filter((F.col("bin") > 0) & (F.col("bin") < F.col("__k")))
    return rows.groupBy(*key, "bin").agg(median(y).alias("y"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def adaptive_edges(width, centres=(0.0, 0.5), coarse=0.02, per_event=10) -> Column:
    """Phase edges: coarse everywhere, fine around the centres, over one and a half times the event's share of a cycle."""
    w = S.col(width)
    parts = [F.transform(F.sequence(F.lit(0), F.lit(int(round(1 / coarse)))), lambda i: F.round(-0.5 + i * coarse, 9))]
    for c in centres:
        parts.append(F.filter(F.transform(F.sequence(F.lit(-per_event), F.lit(per_event)), lambda i: F.round(c + i * 0.75 * w / per_event, 9)), lambda e: (e > -0.5) & (e < 0.5)))
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def downsampled(df: DataFrame, key: list[str], width: float, cadence_days: float, t="t", y="flux", share=0.8) -> DataFrame:
    """Mean of fixed blocks of time since the key's first point; blocks at least 80 % full stay."""
    start = F.min(t).over(Window.partitionBy(*key))
    got = df.withColumn("block", F.floor((F.col(t) - start) / width)).groupBy(*key, "block").agg(F.avg(t).alias("t"), F.avg(y).alias("flux"), F.count(F.lit(1)).alias("n"))
    return got.filter(F.col("n") >= share * width / cadence_days)


def time_bins(df: DataFrame, key: list[str], width: float, t="t", y="flux", err="flux_err") -> DataFrame:
    """Inverse-variance means of blocks of time."""
    w = 1 / F.pow(F.col(err), 2)
    got = df.withColumn("block", F.floor(F.col(t) / width)).groupBy(*key, "block").agg(F.sum(w * F.col(t)).alias("a"), F.sum(w * F.col(y)).alias("b"), F.sum(w).alias("c"), F.count(F.lit(1)).alias("n"))
    return got.select(*key, "block", (F.col("a") / F.col("c")).alias("t"), (F.col("b") / F.col("c")).alias("flux"), (1 / F.sqrt("c")).alias("err"), "n")


def red_noise(df: DataFrame, key: list[str], block: int, t="t", y="flux") -> DataFrame:
    """Per key: scatter of block means over what white noise would give, at least 1."""
    w = Window.partitionBy(*key).orderBy(t)
    rows = df.withColumn("__b", F.floor((F.row_number().over(w) - 1) / block))
    means = rows.groupBy(*key, "__b").agg(F.avg(y).alias("m"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == block)
    got = means.groupBy(*key).agg(F.stddev_pop("m").alias("s"), F.count(F.lit(1)).alias("blocks")).join(df.groupBy(*key).agg(F.stddev_pop(y).alias("w")), key)
    return got.select(*key, "blocks", F.greatest(F.lit(1.0), F.try_divide(F.col("s"), F.col("w") / F.sqrt(F.lit(float(block))))).alias("beta"))


def zoom(df: DataFrame, key: list[str], widths=3.0, t="t", centre=0.0) -> DataFrame:
    """Points within so many durations of an event, with their hours from it."""
    x = (S.phase(F.col(t) - S.col(centre) * F.col("period"), "period", "t0")) * F.col("period")
    return df.withColumn("hours", x * 24).filter(F.abs("hours") < widths * F.col("duration") * 24)


def primary_width(folded: DataFrame, key: list[str], share=0.5) -> DataFrame:
    """From phase bins: depth of the lowest, and how many neighbouring bins around it stay below a share of the depth."""
    w = Window.partitionBy(*key)
    base = folded.withColumns({"base": median("flux").over(w), "low": F.min("flux").over(w), "at": F.min_by("bin", F.struct("flux", "bin")).over(w)})
    below = base.filter(F.col("flux") <= F.col("base") - share * (F.col("base") - F.col("low")))
    runs = below.withColumn("g", F.col("bin") - F.row_number().over(Window.partitionBy(*key).orderBy("bin")))
    got = runs.groupBy(*key, "g").agg(F.count(F.lit(1)).alias("width_bins"), F.min("bin").alias("a"), F.max("bin").alias("b"), F.first("at").alias("at"), F.first("base").alias("base"), F.first("low").alias("low"))
    return got.filter(F.col("at").between(F.col("a"), F.col("b"))).select(*key, (F.col("base") - F.col("low")).alias("depth"), "width_bins", "at")
