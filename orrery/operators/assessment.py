"""Limits and checks on what one object can be; its points and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions import scalars as S
from orrery.functions.scalars import col

# Limits and labels of the surveyed rules.
RV_COVERAGE, RV_NOISE, LEAST_TRANSITS = 0.9, 5.0, 10
SUBSTELLAR, DEEP_EVENT, TWIN_RATIO = 0.08, 0.02, 0.5
LARGEST_DWARF, MASS_RATIOS = 1.5, (0.5, 2.0)


def ranked_parts(points: DataFrame, key: list[str], part: str, most: int = 3, least: int = 50) -> DataFrame:
    """(key, part, n, rank): a key's parts of at least so many points, most points first, then by part; the first few."""
    from pyspark.sql.window import Window

    counts = points.groupBy(*key, part).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    w = Window.partitionBy(*key).orderBy(F.desc("n"), part)
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def epoch_arrays(df: DataFrame, t: str, flux: str, err: str, flags: list[str], offset: float, key: str | None = None, unknown: str = "drop") -> DataFrame:
    """(key, t_mjd, flux, flux_err): finite points with a positive error and no flag set. The scale of the times is told for
    each key (or for all points) from where their median lies: days from ``offset``, modified or full Julian dates. A
    median of no known scale leaves the points out, or is an error with unknown='error'.

    The median itself isn't needed: counts of the times below each scale's ends say whether both middle ones lie inside, a
    partial aggregation of any number of points."""
    keys = [F.col(key)] if key else []
    x = df.select(*keys, F.col(t).try_cast("double").alias("t"), F.col(flux).try_cast("double").alias("flux"), F.col(err).try_cast("double").alias("flux_err"), *[F.lower(F.col(c).cast("string")).alias(f"__f{i}") for i, c in enumerate(flags)])
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("t", "flux", "flux_err")]
    kept = x.filter(finite[0] & finite[1] & finite[2] & (F.col("flux_err") > 0))
    for i in range(len(flags)):
        kept = kept.filter(~F.coalesce(F.col(f"__f{i}").isin("true", "1", "1.0"), F.lit(False)))
    scales = {"offset": (1000, 5000, F.col("t") + offset - 2400000.5), "modified": (50000, 70000, F.col("t")), "full": (2400000, 2600000, F.col("t") - 2400000.5)}
    n = F.count(F.lit(1))
    middle = lambda lo, hi: (F.count(F.when(F.col("t") <= lo, 1)) < F.ceil(n / 2)) & (F.count(F.when(F.col("t") < hi, 1)) > F.floor(n / 2))
    told = F.coalesce(*[F.when(middle(lo, hi), name) for name, (lo, hi, _) in scales.items()])
    counts = kept.groupBy(*[k.alias("__key") for k in keys]).agg(told.alias("scale"))
    met = kept.join(counts, F.col(key).eqNullSafe(F.col("__key"))) if key else kept.crossJoin(F.broadcast(counts))  # one row
    mjd = F.coalesce(*[F.when(F.col("scale") == name, value) for name, (_, _, value) in scales.items()])
    if unknown == "error":
        mjd = F.when(F.col("scale").isNull(), F.raise_error(F.lit("times of no known scale")).cast("double")).otherwise(mjd)
    return met.select(*keys, mjd.alias("t_mjd"), "flux", "flux_err").filter("t_mjd IS NOT NULL")


def injected_box(t, flux, period, t0, duration, depth) -> Column:
    """The flux with a box-shaped event of a depth put in; the edges belong to it."""
    offset = F.pmod(col(t) - col(t0) + col(period) / 2, col(period)) - col(period) / 2
    return F.when(F.abs(offset) <= col(duration) / 2, col(flux) * (1 - col(depth))).otherwise(col(flux))


def testable(period, period_error, t0, t0_error, duration, start: float, middle: float, end: float, transits: float = 25.0, most_error: float = 0.25, least_inside: float = 1.0) -> Column:
    """Whether a mission's few measurements can test an ephemeris: errors at its middle and at its worse end, the points
    expected inside events, and the verdict."""
    at = lambda x: S.timing_error(F.lit(float(x)), period, period_error, t0, t0_error)
    worst, inside = F.greatest(at(start), at(end)), transits * F.least(F.lit(1.0), col(duration) / col(period))
    return F.struct(((worst <= most_error * col(duration)) & (inside >= least_inside)).alias("testable"), at(middle).alias("error_middle"), worst.alias("error_worst"), inside.alias("expected_inside"))


def velocity_limits(amplitude, sigma, transits) -> Column:
    """Bounds on a velocity amplitude from a peak-to-peak range: the lower one with the noise's range taken off, the upper
    one, of many random phases, from the part of a sinusoid that they cover."""
    known = col(amplitude).isNotNull() & ~F.isnan(col(amplitude))
    lower = F.when(known & col(sigma).isNotNull(), F.greatest(F.lit(0.0), col(amplitude) - RV_NOISE * col(sigma)) / 2)
    upper = F.when(known & (col(transits) >= LEAST_TRANSITS), (col(amplitude) + 2 * F.coalesce(col(sigma), F.lit(0.0))) / (2 * RV_COVERAGE))
    return F.struct(lower.alias("lower"), upper.alias("upper"))


def main_sequence(total_mass, radius, light_ratio, primary_mass=None) -> Column:
    """Whether a total mass fits two dwarfs: the primary's mass as given, else from its radius, the ratio from the light."""
    given = F.lit(None).cast("double") if primary_mass is None else col(primary_mass)
    m1 = F.when(given > 0, given).when(col(radius) < LARGEST_DWARF, F.pow(col(radius), 1 / 0.8))
    expected = F.when(col(radius).isNotNull(), m1 * (1 + F.pow(F.greatest(col(light_ratio), F.lit(0.0)), 0.25)))
    ratio = col(total_mass) / expected
    return F.struct(expected.alias("expected"), ratio.alias("ratio"), ratio.between(*MASS_RATIOS).alias("consistent"))


def static_verdict(most_companion, depth, second_depth) -> Column:
    """What a star of hardly any velocity change can be, given the mass that its companion has at most."""
    ratio = F.when(col(depth) > 0, col(second_depth) / col(depth))
    low = F.when(ratio >= TWIN_RATIO, "STATIC_OR_TWIN").when(col(depth) >= DEEP_EVENT, "BLEND_INDICATED").otherwise("SUBSTELLAR_OR_BLEND")
    return F.when(col(most_companion) < SUBSTELLAR, low).otherwise("CONSISTENT")


def period_support(ours, theirs, kind) -> Column:
    """(relation, kind): how a solution's period supports ours (same, half or double), with the kind of solution."""
    has = F.coalesce(col(theirs) != 0, F.lit(False))
    relation = S.period_relation(ours, theirs)
    return F.struct(F.when(has & relation.isin("same", "half", "double"), relation).alias("relation"), F.when(has, col(kind)).alias("kind"))


def ranked_by(df: DataFrame, column: str, order: list[str], *then: Column) -> DataFrame:
    """Rows in the order of a list of values (others last), then by further columns."""
    return df.orderBy(F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.lit(0)), F.lit(len(order) + 1)), *then)


def variant_tag(parts: dict[str, float | None]) -> str:
    """A file-name tag of the options that differ from the default run: name and value, joined by underscores."""
    return "_".join(f"{name}{value:g}" for name, value in parts.items() if value is not None)


def galactic(ra, dec) -> tuple[Column, Column]:
    """Galactic longitude and latitude in degrees of equatorial ones (J2000)."""
    pole_ra, pole_dec, node = 192.85948, 27.12825, 122.93192  # fixed values
    a, d, p = F.radians(col(ra) - pole_ra), F.radians(col(dec)), F.radians(F.lit(pole_dec))
    b = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(d) * F.sin(p) + F.cos(d) * F.cos(p) * F.cos(a))))
    y, x = F.cos(d) * F.sin(a), F.sin(d) * F.cos(p) - F.cos(d) * F.sin(p) * F.cos(a)
    return F.pmod(F.lit(node) - F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(b)
