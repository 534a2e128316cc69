"""Scalar expressions: phases, ratios, magnitudes, parsing. All are built from Spark functions on columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000.0


def col(x) -> Column:
    """A column, a column's name or a number."""
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


# -- time and phase ---------------------------------------------------------------------------------------------------


def days(ts) -> Column:
    """A timestamp as a double of days since 1970; without a zone it is taken in the session's, which should be UTC."""
    return F.unix_micros(col(ts).cast("timestamp")) / F.lit(DAY_MICROS)


def phase(t, period, t0) -> Column:
    """Phase in [-0.5, 0.5), zero at t0."""
    p = col(period)
    return F.pmod(col(t) - col(t0) + p / 2, p) / p - 0.5


def circular(d) -> Column:
    """Distance of two phases on the circle, from their difference."""
    return F.abs(F.pmod(col(d) + 0.5, F.lit(1.0)) - 0.5)


def epoch(t, period, t0) -> Column:
    """Nearest cycle number; halves go to the even one."""
    return F.rint((col(t) - col(t0)) / col(period)).cast("long")


def is_odd(n) -> Column:
    return F.pmod(col(n), F.lit(2)) != 0


def in_event(t, period, t0, duration, widths: float = 1.0) -> Column:
    """Whether t lies within half a duration, times widths, of an event."""
    return F.abs(phase(t, period, t0)) < col(duration) / col(period) / 2 * widths


def event_mask(t, period, t0, duration, second_phase=0.5, widths: float = 1.0) -> Column:
    """Inside the main or the second event."""
    f, half = phase(t, period, t0), col(duration) / col(period) / 2 * widths
    return (circular(f) < half) | (circular(f - col(second_phase)) < half)


def trapezoid(t, period, t0, duration, ingress, depth, depth2=0.0) -> Column:
    """Fractional dimming of two events a cycle, the second half a cycle later."""
    half = col(duration) / 2
    slope = F.greatest(col(ingress) * half, F.lit(1e-9))

    def dip(centre: Column, d) -> Column:
        x = F.abs(F.pmod(col(t) - centre + col(period) / 2, col(period)) - col(period) / 2)
        return F.when(col(d) > 0, col(d) * F.least(F.greatest((half - x) / slope, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)

    return dip(col(t0), depth) + dip(col(t0) + col(period) / 2, depth2)


def timing_error(at, period, period_error, t0, t0_error) -> Column:
    """One-sigma error of a predicted time some cycles from t0."""
    return F.hypot(col(t0_error), F.abs((col(at) - col(t0)) / col(period)) * col(period_error))


def window_days(first, number, length) -> tuple[Column, Column]:
    """Start and end of the number-th window of a regular calendar."""
    start = col(first) + (col(number) - 1) * col(length)
    return start, start + col(length)


# -- numbers ----------------------------------------------------------------------------------------------------------


def clean(x, digits: int | None = None) -> Column:
    """NaN and infinities as null; rounded if digits are given."""
    x = col(x).cast("double")
    ok = F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)
    return ok if digits is None else F.round(ok, digits)


def to_double(x) -> Column:
    """Text as a number; null where it isn't one, or not finite."""
    return clean(F.trim(col(x).cast("string")).try_cast("double"))


def to_bool(x) -> Column:
    return F.coalesce(F.lower(F.trim(col(x).cast("string"))).isin("true", "1", "1.0", "yes"), F.lit(False))


def ratio(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def percent_text(k, n) -> Column:
    """'k/n (p%)', or 'k/0' without any."""
    return F.when(col(n) > 0, F.format_string("%d/%d (%.1f%%)", col(k), col(n), 100.0 * col(k) / col(n))).otherwise(F.format_string("%d/%d", col(k), col(n)))


def bisect(f, low, high, steps: int = 200) -> Column:
    """The root of an increasing function of a column, by a fold of halvings."""
    start = F.struct(col(low).cast("double").alias("lo"), col(high).cast("double").alias("hi"))

    def half(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        return F.when(f(mid) < 0, F.struct(mid.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, half, lambda acc: (acc["lo"] + acc["hi"]) / 2)


def interpolate(x, points: list[tuple[float, float]]) -> Column:
    """Piecewise-linear through the points, flat outside."""
    x = col(x)
    out = F.lit(float(points[-1][1]))
    for (a, fa), (b, fb) in reversed(list(zip(points, points[1:]))):
        out = F.when(x <= b, fa + (fb - fa) * (F.greatest(x, F.lit(float(a))) - a) / (b - a)).otherwise(out)
    return out


def grid_size(base: int, span, cap: float) -> Column:
    """Grid points for a span of days, in proportion to 28 days, between 1 and cap times the base."""
    return F.floor(base * F.least(F.lit(float(cap)), F.greatest(F.lit(1.0), col(span) / 28.0))).cast("long")


def same_value(a, b, tolerance: float = 1e-6) -> Column:
    """Null-safe and tolerant: blanks are equal, numbers within the tolerance, other text when it is equal trimmed."""
    a, b = (F.nullif(F.nullif(F.nullif(F.trim(col(x).cast("string")), F.lit("")), F.lit("nan")), F.lit("--")) for x in (a, b))
    na, nb = a.try_cast("double"), b.try_cast("double")
    return a.eqNullSafe(b) | F.coalesce(F.abs(na - nb) <= tolerance * F.greatest(F.lit(1.0), F.abs(nb)), F.lit(False))


# -- brightness -------------------------------------------------------------------------------------------------------


def flux_ratio(dmag) -> Column:
    return F.pow(F.lit(10.0), -0.4 * col(dmag))


def depth_to_magnitudes(depth) -> Column:
    d = col(depth)
    return F.when((d > 0) & (d < 1), -2.5 * F.log10(1 - d))


def required_depth(depth, target_mag, neighbour_mag, share=1.0) -> Column:
    """The depth a neighbour must have itself; over 1 is impossible. share: of its light that enters the aperture."""
    return col(depth) * flux_ratio(col(target_mag) - col(neighbour_mag)) / F.greatest(col(share), F.lit(1e-12))


def centroid_tolerance(snr, floor, width: float) -> Column:
    s = F.when(col(snr) > 0, col(snr)).otherwise(1.0)
    return F.greatest(col(floor), 3.0 * width / s)


def distance_parsec(parallax, error, least_snr: float = 5.0) -> Column:
    p = col(parallax)
    return F.when((p > 0) & (col(error) > 0) & (F.round(p / col(error), 2) >= least_snr), 1000.0 / p)


def absolute_magnitude(mag, distance) -> Column:
    return col(mag) - 5 * F.log10(col(distance)) + 5


# -- positions --------------------------------------------------------------------------------------------------------


def separation_arcsec(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance, right across 0/360 and near the poles."""
    a, b = F.radians(col(dec1)), F.radians(col(dec2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(ra2) - col(ra1)) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))) * 3600


def sexagesimal(deg, hours: bool = False) -> Column:
    """'hh mm ss.ss' of a right ascension, or '+dd mm ss.s' of a declination."""
    x = F.abs(col(deg)) / (15 if hours else 1)
    total = F.round(x * 3600, 2 if hours else 1)
    parts = [F.floor(total / 3600).cast("int"), F.floor(F.pmod(total, F.lit(3600.0)) / 60).cast("int"), F.pmod(total, F.lit(60.0))]
    return F.format_string("%02d %02d %05.2f", *parts) if hours else F.concat(F.when(col(deg) < 0, "-").otherwise("+"), F.format_string("%02d %02d %04.1f", *parts))


# -- periods ----------------------------------------------------------------------------------------------------------

#: These ratios and labels, and the two "no period" strings below.
RATIOS = [("1x", 1.0), ("2x", 2.0), ("0.5x", 0.5), ("3x", 3.0), ("1/3x", 1.0 / 3.0)]


def period_flag(ours, theirs, tolerance: float = 0.01) -> Column:
    """How our period stands to a catalog's, in a fixed order of ratios."""
    a, b = clean(ours), clean(theirs)
    r = a / b
    out = F.concat(F.lit("disagrees(ratio="), F.format_string("%.4f", r), F.lit(")"))
    for label, x in reversed(RATIOS):
        out = F.when(F.abs(r - x) / x < tolerance, f"agrees_{label}").otherwise(out)
    return F.when(b.isNull() | (b <= 0), "no_catalog_period").when(a.isNull() | (a <= 0), "no_bls_period").otherwise(out)


def period_relation(ours, theirs, tolerance: float = 0.02) -> Column:
    a, b = clean(ours), clean(theirs)
    r = b / a
    near = [F.when(F.abs(r / x - 1) < tolerance, name) for name, x in (("same", 1.0), ("half", 0.5), ("double", 2.0))]
    return F.when((a > 0) & (b > 0), F.coalesce(*near, F.lit("unrelated")))


def period_match(theirs, ours, tolerance: float = 0.01, ratios=(1.0, 0.5, 2.0)) -> Column:
    """The least (error, ratio) over two arrays of periods and the ratios, within the tolerance; else null."""
    k = F.array(*[F.lit(float(x)) for x in ratios])
    errors = F.transform(
        col(theirs), lambda c: F.transform(F.filter(col(ours), lambda o: o > 0), lambda o: F.transform(k, lambda m, i: F.struct(F.abs(c / (m * o) - 1).alias("error"), i.alias("nth"), m.alias("ratio"))))
    )
    return F.array_min(F.filter(F.flatten(F.flatten(errors)), lambda x: x["error"] < tolerance))


def outcome(passed, found, true, tolerance: float = 0.01) -> Column:
    """missed, exact, alias (half or double) or wrong."""
    r = clean(found) / col(true)
    alias = (F.abs(r - 2) < 2 * tolerance) | (F.abs(r - 0.5) < 0.5 * tolerance)
    return F.when(~F.coalesce(col(passed), F.lit(False)), "missed").when(r.isNull() | (clean(found) == 0), "wrong").when(F.abs(r - 1) < tolerance, "exact").when(alias, "alias").otherwise("wrong")


def refined_period(ours, refined, tolerance: float = 2e-3) -> tuple[Column, Column]:
    """The refined period where it agrees with ours, and which it was."""
    ok = F.coalesce(F.abs(col(refined) - col(ours)) / col(ours) <= tolerance, F.lit(False))
    return F.when(ok, col(refined)).otherwise(col(ours)), F.when(ok, "refined").otherwise("own")


# -- orbits -----------------------------------------------------------------------------------------------------------


def kepler_anomaly(mean, e, steps: int = 60) -> Column:
    """Eccentric anomaly by Newton steps."""
    m, ecc = col(mean), col(e)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), m + ecc * F.sin(m), lambda x, _: x - (x - ecc * F.sin(x) - m) / (1 - ecc * F.cos(x)))


def true_anomaly(eccentric, e) -> Column:
    return 2 * F.atan2(F.sqrt(1 + col(e)) * F.sin(col(eccentric) / 2), F.sqrt(1 - col(e)) * F.cos(col(eccentric) / 2))


def ecosw(second_phase) -> Column:
    return math.pi / 2 * (col(second_phase) - 0.5)


def mass_function(k_kms, period_days, e=0.0) -> Column:
    """In solar masses."""
    return 1.0361e-7 * F.pow(1 - col(e) * col(e), 1.5) * F.pow(col(k_kms), 3) * col(period_days)


def least_companion(f, mass) -> Column:
    """The companion's mass for a mass function seen edge-on."""
    return bisect(lambda m: F.pow(m, 3) / F.pow(col(mass) + m, 2) - col(f), 0.0, 1000.0, 80)


# -- text -------------------------------------------------------------------------------------------------------------


def split_list(x, sep: str = ",") -> Column:
    """The parts of a joined cell, trimmed, without empty ones; null gives none."""
    return F.filter(F.transform(F.split(F.coalesce(col(x), F.lit("")), sep), lambda p: F.trim(p)), lambda p: p != "")


def type_tokens(x) -> Column:
    """Distinct upper-case tokens of a variability type; sorted."""
    s = F.upper(F.trim(F.coalesce(col(x).cast("string"), F.lit(""))))
    s = F.regexp_replace(F.regexp_replace(F.when(s == "NAN", "").otherwise(s), "[:?]", ""), r"[/+|,\s]+", " ")
    return F.array_sort(F.array_distinct(F.filter(F.split(s, " "), lambda p: p != "")))


def has_any(tokens, wanted: list[str]) -> Column:
    return F.arrays_overlap(col(tokens), F.array(*map(F.lit, wanted)))


def is_clear_of(text, words: list[str]) -> Column:
    """No word of a blocklist occurs."""
    return ~F.rlike(F.coalesce(col(text), F.lit("")), F.lit("(?i)" + "|".join(words)))


def worst_of(flags, order: list[str]) -> Column:
    """The flag of an array that comes first in an order of severity."""
    ranks = F.transform(col(flags), lambda f: F.array_position(F.array(*map(F.lit, order)), f))
    at = F.array_min(F.filter(ranks, lambda r: r > 0))
    return F.get(F.array(*map(F.lit, order)), (at - 1).cast("int"))


def ladder(*steps: tuple, otherwise=None) -> Column:
    """The first value whose condition holds; an unknown condition does not hold."""
    return reduce(lambda acc, s: F.when(F.coalesce(s[0], F.lit(False)), s[1]).otherwise(acc), reversed(steps), F.lit(otherwise))
