"""Timing, second events, harmonics, cut events and velocities over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import kernels, shapes, timing
from orrery.plans.base import LIGHTS, SERIES, Registry

R = Registry()
K = "band"


def times(t):
    """Times of events against the centre of the mean one (301 shifts, a gain of 25), with the part of each."""
    rows = timing.centred(t.lights, timing.templates(t.lights, K), K)
    found = kernels.event_times(rows, K, shifts=301, widths=0.75, least_gain=25.0)
    return found.withColumn("part", F.floor((F.col("time") - 19723) / 7))


@R.add(rounded=("offset", "score", "base"))
def event_centres(t):
    """Mean events: how far their mirror axis lies from the nominal t0 (a tenth of a day is planted)."""
    return timing.templates(t.lights, K).drop("shape")


@R.add(f"""WITH {SERIES}, {LIGHTS}, e AS (SELECT *, round_even((t - t0) / period, 0)::BIGINT AS epoch, t - t0 - round_even((t - t0) / period, 0) * period AS x FROM l), n AS (SELECT * FROM e WHERE abs(x) < 2 * duration),
c AS (SELECT band, epoch, count(*) AS n, quantile_cont(step, 0.5) AS cadence FROM (SELECT band, epoch, lead(x) OVER (PARTITION BY band, epoch ORDER BY x) - x AS step FROM n) GROUP BY ALL),
i AS (SELECT band, epoch, x, duration, coalesce(lead(x) OVER w, duration) - x AS gap, CASE WHEN lag(x) OVER w IS NULL THEN x + duration END AS head FROM n WHERE abs(x) < duration WINDOW w AS (PARTITION BY band, epoch ORDER BY x)),
g AS (SELECT band, epoch, count(*) AS n_in, max(greatest(gap, head)) AS largest_gap FROM i GROUP BY ALL)
SELECT c.band, c.epoch, coalesce(n_in, 0) AS n_in, cadence, largest_gap, coalesce(c.n >= 4 AND cadence > 0 AND n_in >= 0.75 * 2 * 0.6 / cadence AND largest_gap <= greatest(0.3 * 0.6, 4 * cadence), false) AS covered FROM c LEFT JOIN g ON c.band = g.band AND c.epoch = g.epoch""", ("cadence", "largest_gap"))
def covered_events(t):
    return timing.covered_events(t.lights, K)


@R.add(rounded=("t0", "period"))
def centre_lines(t):
    """Lines through the events' times, clipped until nothing changes."""
    return timing.robust_lines(times(t), K)


@R.add(rounded=("period", "score"))
def refined_main_periods(t):
    """Each type's period by its main events alone, from a nominal one that is 0.1 % off."""
    return timing.refined_main_periods(t.lights.withColumns({"t0": F.col("t0") + 0.1, "period": F.lit(3.003), "duration": F.lit(0.4)}), K)


@R.add(rounded=("t0", "depth"))
def aligned_parts(t):
    """t0 on the main event of each half of the month."""
    return timing.aligned_parts(t.lights.withColumn("half", F.floor((F.col("t") - 19723) / 15)), K, "half", 25)


@R.add(rounded=("offset", "gain", "amplitude", "rival_gain"))
def offset_scans(t):
    """Where each week's events lie against the ephemeris, and whether that is the only place."""
    return timing.offset_scans(t.lights, timing.templates(t.lights, K), K, "part", 0.4)


@R.add(rounded=("chi2", "p_value", "cycles", "lag"))
def rolling_origins(t):
    """Each week from all others, and all later weeks from the first ones."""
    return timing.holdout_tests(times(t), K)


@R.add(rounded=("least_p", "longest_lag"))
def holdout_reports(t):
    return timing.holdout_report(timing.holdout_tests(times(t), K), K)


def seasons(t):
    found = timing.season_times(t.lights, timing.templates(t.lights, K), K, "stretch", least=10, least_in=3)
    return found.withColumns({"main": F.col("stretch") % 2 == 0, "period": F.lit(3.0)})


@R.add(rounded=("oc_minutes", "err_minutes", "gain"))
def season_times(t):
    """A time of each stretch of three days, its error from 60 weightings of its points."""
    return seasons(t).drop("main", "period")


DRIFT = ("chi2_line", "p_line", "chi2_parabola", "p_parabola", "curve", "curve_err", "p_others", "range_minutes")


@R.add(rounded=DRIFT)
def drift_verdicts(t):
    return timing.drift_verdicts(seasons(t), [K])


@R.add(rounded=("share",))
def false_drift_rate(t):
    """Verdicts of constant periods with the seasons' errors, 30 times a key."""
    return timing.false_drift_rate(seasons(t), [K])


@R.add(rounded=("parabola_minutes", "sigma_minutes", "minus_line_minutes"))
def drift_forecasts(t):
    """Each key's parabola over the cycles of the following month."""
    return timing.drift_forecast(seasons(t).withColumns({"first": F.lit(11), "last": F.lit(20)}), [K], "first", "last")


@R.add(rounded=("phase", "depth", "snr", "phase_a", "snr_a", "phase_b", "snr_b", "phase_err", "ecosw", "ecosw_err", "third_phase", "third_depth", "third_snr", "fast_period", "fast_amplitude", "fast_chance"))
def secondary_assessments(t):
    """Second events of every type of events, held against themselves in alternating weeks."""
    rows = t.lights.withColumn("t0", F.col("t0") + 0.1)
    return shapes.secondary_assessments(rows, K, "part", least_half=20)


@R.add(rounded=("main_shift", "at_snr", "p_value", "scan_phase"))
def confirmed_elsewhere(t):
    """A second event expected at phase 0.5, against boxes at other phases."""
    rows = t.lights.withColumns({"t0": F.col("t0") + 0.1, "duration": F.lit(0.2)})
    return shapes.confirmed_elsewhere(rows, rows.select(K).distinct().withColumn("second_phase", F.lit(0.5)), K)



@R.add(rounded=("span", "level", "trend", "a1", "b1", "a2", "b2", "sigma", "inflation", "rotation_period", "rotation_amplitude", "rotation_snr"))
def segment_harmonics(t):
    """Orbital harmonics outside events, by half of the month."""
    rows = t.lights.withColumn("half", F.floor((F.col("t") - 19723) / 15))
    return shapes.segment_harmonics(rows, K, "half", least=20).drop("cov")


@R.add(rounded=("chi2", "p_value", "change", "rotation_period", "rotation_amplitude"))
def spot_verdicts(t):
    rows = t.lights.withColumn("half", F.floor((F.col("t") - 19723) / 15))
    return shapes.spot_verdicts(shapes.segment_harmonics(rows, K, "half", least=20), K)


CUT = """k AS (SELECT band, t, flux, kind, floor((t - t0) / period - centre + 0.5)::BIGINT AS cycle, t - t0 - (floor((t - t0) / period - centre + 0.5) + centre) * period AS x, duration FROM l, (VALUES ('main', 0.0::DOUBLE), ('second', 0.5)) v(kind, centre)),
z AS (SELECT *, x / duration AS u, abs(x / duration) > 0.6 AS o FROM k WHERE abs(x) < 1.6 * duration),
m AS (SELECT band, kind, cycle, count(*) FILTER (o AND u < 0) AS b, count(*) FILTER (o AND u > 0) AS a, count(*) FILTER (o) AS s0, sum(u) FILTER (o) AS s1, sum(u * u) FILTER (o) AS s2, sum(u * u * u) FILTER (o) AS s3, sum(u * u * u * u) FILTER (o) AS s4,
  sum(flux) FILTER (o) AS y0, sum(u * flux) FILTER (o) AS y1, sum(u * u * flux) FILTER (o) AS y2 FROM z GROUP BY ALL HAVING count(*) >= 10 AND count(*) FILTER (o AND u < 0) >= 5 AND count(*) FILTER (o AND u > 0) >= 5),
d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2) AS d, s0 * s2 - s1 * s1 AS f FROM m),
c AS (SELECT band, kind, cycle, CASE WHEN a + b >= 20 THEN (y0 * (s2 * s4 - s3 * s3) - s1 * (y1 * s4 - s3 * y2) + s2 * (y1 * s3 - s2 * y2)) / d ELSE (s2 * y0 - s1 * y1) / f END AS c0,
  CASE WHEN a + b >= 20 THEN (s0 * (y1 * s4 - s3 * y2) - y0 * (s1 * s4 - s2 * s3) + s2 * (s1 * y2 - y1 * s2)) / d ELSE (s0 * y1 - s1 * y0) / f END AS c1,
  CASE WHEN a + b >= 20 THEN (s0 * (s2 * y2 - y1 * s3) - s1 * (s1 * y2 - y1 * s2) + y0 * (s1 * s3 - s2 * s2)) / d ELSE 0.0 END AS c2 FROM d),
q AS (SELECT z.band AS band, z.t AS t, z.kind AS kind, z.cycle AS cycle, z.x AS x, z.flux / (c0 + z.u * (c1 + z.u * c2)) AS flux FROM z JOIN c ON z.band = c.band AND z.kind = c.kind AND z.cycle = c.cycle)"""


@R.add(f"WITH {SERIES}, {LIGHTS}, {CUT} SELECT * FROM q", ("x", "t", "flux"))
def cut_events(t):
    """Main and second events, each over a quadratic through its own sides."""
    return shapes.cut_events(t.lights, K)


@R.add(f"""WITH {SERIES}, {LIGHTS}, {CUT}, p AS (SELECT DISTINCT band, part FROM l), r AS (SELECT band, part, row_number() OVER (PARTITION BY band ORDER BY part) - 1 AS n, count(*) OVER (PARTITION BY band) AS m FROM p)
SELECT q.band AS band, kind, floor(n * least(m, 2) / m)::BIGINT AS block, floor(x / 0.1)::BIGINT AS bin, avg(x) AS x, quantile_cont(q.flux, 0.5) AS flux, count(*) AS n FROM q JOIN (SELECT DISTINCT band, t, part FROM l) l2 ON q.band = l2.band AND q.t = l2.t JOIN r ON r.band = l2.band AND r.part = l2.part GROUP BY 1, 2, 3, 4""", ("x", "flux"))
def event_blocks(t):
    rows = t.lights
    return shapes.event_blocks(shapes.cut_events(rows, K), K, "part", rows.select(K, "t", "part").distinct(), 0.1, 2)


@R.add(f"""WITH {SERIES}, a AS (SELECT k, t, period, flux AS v, 0.05 * (1 + event_id % 3) AS e, 0.3::DOUBLE AS ecc, 0.7::DOUBLE AS w, t0 FROM s),
b AS (SELECT *, 2 * atan(sqrt((1 - ecc) / (1 + ecc)) * tan((pi() / 2 - w) / 2)) AS ev FROM a), m AS (SELECT *, ev - ecc * sin(ev) + 2 * pi() * (t - t0) / period AS m FROM b),
n AS (SELECT *, list_reduce(list_prepend(m + ecc * sin(m), list_transform(range(60), lambda i: i::DOUBLE)), lambda x, i: x - (x - ecc * sin(x) - m) / (1 - ecc * cos(x))) AS ea FROM m),
g AS (SELECT k, v, 1 / e / e AS w2, cos(2 * atan2(sqrt(1 + ecc) * sin(ea / 2), sqrt(1 - ecc) * cos(ea / 2)) + w) + ecc * cos(w) AS g FROM n),
f AS (SELECT k, count(*) AS n, sum(w2) AS s, sum(w2 * g) AS sg, sum(w2 * v) AS sy, sum(w2 * g * g) AS sgg, sum(w2 * g * v) AS sgy, sum(w2 * v * v) AS syy FROM g GROUP BY k), h AS (SELECT *, s * sgg - sg * sg AS d FROM f)
SELECT k, n, (sgg * sy - sg * sgy) / d AS gamma, (s * sgy - sg * sy) / d AS k1, sqrt(s / d) AS k1_err, syy - sy * sy / s - pow(s * sgy - sg * sy, 2) / d / s AS chi2, syy - sy * sy / s AS chi2_constant, pow(s * sgy - sg * sy, 2) / d / s AS gain, s * sgy - sg * sy < 0 AS reversed FROM h""", ("gamma", "k1", "k1_err", "chi2", "chi2_constant", "gain"), 5)
def velocity_fits(t):
    """Amplitude and systemic velocity at a fixed, eccentric shape."""
    rows = t.series.select("k", "t", "period", "t0", F.col("flux").alias("v"), (0.05 * (1 + F.col("event_id") % 3)).alias("v_err"), F.lit(0.3).alias("e"), F.lit(0.7).alias("omega"))
    return shapes.velocity_fits(rows, ["k"])


@R.add("""WITH p AS (SELECT p_partkey, 2.0 + p_size / 10.0 AS ours, CASE WHEN p_partkey % 7 > 0 THEN (2.0 + p_size / 10.0) * CASE p_partkey % 3 WHEN 0 THEN 1.005 WHEN 1 THEN 1.5 ELSE 7.0 END END AS theirs, 0.01 * (p_partkey % 50) AS e, CASE WHEN p_partkey % 5 > 0 THEN 0.0005 * (p_partkey % 5) END AS s, 3.0 * (p_partkey % 120) AS w, 0.02 * (p_partkey % 11) AS c FROM part)
SELECT p_partkey, abs(theirs / ours - 1) < 0.01 AS same_period, theirs / ours > 5 AS outer_orbit, CASE WHEN theirs IS NOT NULL THEN e * cos(radians(w)) END AS ecosw, CASE WHEN abs(theirs / ours - 1) < 0.01 AND s > 0 THEN abs(e * cos(radians(w)) - c) / greatest(s, 0.001) END AS ecosw_sigmas FROM p""", ("ecosw", "ecosw_sigmas"))
def orbit_checks(t):
    k = F.col("p_partkey")
    ours = 2.0 + F.col("p_size") / 10.0
    theirs = F.when(k % 7 > 0, ours * F.when(k % 3 == 0, 1.005).when(k % 3 == 1, 1.5).otherwise(7.0))
    found = shapes.orbit_check(ours, theirs, 0.01 * (k % 50), F.when(k % 5 > 0, 0.0005 * (k % 5)), 3.0 * (k % 120), 0.02 * (k % 11))
    return t.part.select("p_partkey", found.alias("o")).select("p_partkey", "o.*")
