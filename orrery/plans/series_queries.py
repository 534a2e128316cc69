"""Series operators over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import scalars as S
from orrery.functions import stats
from orrery.operators import boxes, kernels, series
from orrery.plans.base import SERIES, Registry, epoch, inside, mod, phase

R = Registry()
K = ["k"]


def med(x: str, where: str | None = None) -> str:
    return f"quantile_cont({x}, 0.5)" + (f" FILTER ({where})" if where else "")


@R.add(f"WITH {SERIES} SELECT event_id, {phase()} AS phase, {epoch()} AS epoch, abs(({epoch()}) % 2) = 1 AS odd, {inside()} AS in_event, abs({mod(phase() + ' - 0.25 + 0.5', '1.0')} - 0.5) AS from_quarter FROM s", ("phase", "from_quarter"))
def phase_fold(t):
    return t.series.select("event_id", S.phase("t", "period", "t0").alias("phase"), S.epoch("t", "period", "t0").alias("epoch"), S.is_odd(S.epoch("t", "period", "t0")).alias("odd"), S.in_event("t", "period", "t0", "duration").alias("in_event"), S.circular(S.phase("t", "period", "t0") - 0.25).alias("from_quarter"))


@R.add(f"WITH {SERIES}, c AS (SELECT * FROM s WHERE flux > 0 AND flux < 2.5) SELECT event_id, k, flux, CASE WHEN (event_id % 10) > 0 THEN 0.01 * (event_id % 10) ELSE stddev_pop(flux) OVER (PARTITION BY k) END AS flux_err FROM c", ("flux", "flux_err"))
def clean_series(t):
    """Unphysical points go; errors that aren't positive are replaced by the key's deviation."""
    rows = t.series.withColumn("flux_err", 0.01 * (F.col("event_id") % 10))
    return series.cleaned(rows, K).select("event_id", "k", "flux", "flux_err")


@R.add(f"WITH {SERIES} SELECT k, count(*) AS n, count(*) FILTER (flux <= 0 OR flux >= 2.5) AS n_unphysical, avg((flux > 1.2)::INT) AS share_bright FROM s GROUP BY k", ("share_bright",))
def quality_gates(t):
    return series.dropped(t.series, K)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t, event_id) > 1.0 THEN 1 ELSE 0 END AS new FROM s),
x AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM g)
SELECT k, segment, count(*) AS n, min(t) AS start, max(t) AS stop FROM x GROUP BY k, segment""", ("start", "stop"))
def gap_segments(t):
    return series.segments(t.series, K, gap=1.0).groupBy("k", "segment").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("start"), F.max("t").alias("stop"))


@R.add(f"""WITH {SERIES}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t) > 1.0 THEN 1 ELSE 0 END AS new FROM s),
x AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS segment FROM g),
m AS (SELECT *, {med('flux')} OVER (PARTITION BY k, segment) AS sm, {med('flux')} OVER (PARTITION BY k) AS gm FROM x),
p AS (SELECT k, segment, count(*) AS n, any_value(sm) AS sm, {med('abs(flux - sm)')} AS mad, stddev_pop(flux) AS sd FROM m GROUP BY k, segment HAVING count(*) >= 5),
w AS (SELECT k, any_value(gm) AS gm, {med('abs(flux - gm)')} AS mad, stddev_pop(flux) AS sd FROM m GROUP BY k),
e AS (SELECT p.k, sm, gm, CASE WHEN p.mad > 0 THEN 1.4826 * p.mad ELSE p.sd END AS s, CASE WHEN w.mad > 0 THEN 1.4826 * w.mad WHEN w.sd > 0 THEN w.sd ELSE 1e-6 END AS gs FROM p JOIN w ON p.k = w.k),
o AS (SELECT k, count(*) AS n, max(abs(sm - gm) / gs) AS off, max(s) AS hi, min(s) AS lo, {med('s', 's > 0')} AS mid FROM e GROUP BY k),
f AS (SELECT DISTINCT s.k, coalesce(n, 0) AS n_segments, CASE WHEN n >= 2 THEN off END AS max_offset, CASE WHEN n >= 2 THEN CASE WHEN mid > 0 THEN hi / mid ELSE 1.0 END END AS max_scatter_ratio, CASE WHEN n >= 2 THEN CASE WHEN mid > 0 THEN lo / mid ELSE 1.0 END END AS min_scatter_ratio FROM s LEFT JOIN o ON s.k = o.k)
SELECT *, coalesce(max_offset > 5 OR max_scatter_ratio > 5 OR min_scatter_ratio < 0.2, false) AS inhomogeneous FROM f""", ("max_offset", "max_scatter_ratio", "min_scatter_ratio"))
def segment_quality(t):
    return series.segment_quality(t.series, K, gap=1.0, least=5)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, {inside()} AS i, {epoch()} AS e, CASE WHEN coalesce(t - lag(t) OVER w > 0.9, false) OR coalesce(lead(t) OVER w - t > 0.9, false) THEN t END AS edge FROM s WINDOW w AS (PARTITION BY k ORDER BY t)),
n AS (SELECT *, last_value(edge IGNORE NULLS) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, first_value(edge IGNORE NULLS) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM g),
c AS (SELECT *, coalesce(least(t - a, b - t) < 0.2, false) AS near FROM n),
p AS (SELECT k, e, count(*) FILTER (i) AS ni, count(*) FILTER (i AND near) AS nc, count(*) FILTER (near) AS c, count(*) AS n FROM c GROUP BY k, e),
o AS (SELECT k, count(*) FILTER (ni >= 2) AS n_events, CASE WHEN sum(ni) > 0 THEN sum(nc) / sum(ni) ELSE 0.0 END AS share_in_near_gap, sum(c) / sum(n) AS share_near_gap FROM p GROUP BY k)
SELECT *, n_events < 3 AS too_few_events, share_in_near_gap > 0.3 AND share_in_near_gap > 3 * share_near_gap AS gap_suspect FROM o""", ("share_in_near_gap", "share_near_gap"))
def event_coverage(t):
    return series.coverage(t.series, K, least_points=2, gap=0.9, near=0.2)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, {inside()} AS i FROM s), m AS (SELECT *, {med('flux', 'NOT i')} OVER (PARTITION BY k) AS o, {med('flux', 'i')} OVER (PARTITION BY k) AS d, count(*) FILTER (i) OVER (PARTITION BY k) AS n_in, count(*) FILTER (NOT i) OVER (PARTITION BY k) AS n_out FROM g),
a AS (SELECT k, any_value(o) AS o, any_value(d) AS d, any_value(n_in) AS n_in, any_value(n_out) AS n_out, 1.4826 * {med('abs(flux - o)', 'NOT i')} AS mad FROM m GROUP BY k)
SELECT k, n_in, n_out, CASE WHEN n_in >= 3 AND n_out >= 3 THEN o - d END AS depth, CASE WHEN n_in >= 3 AND n_out >= 3 AND mad > 0 THEN (o - d) / (mad * sqrt(pi() / 2) / sqrt(n_in)) END AS sigma, NOT (n_in >= 3 AND n_out >= 3) AS mismatch FROM a""", ("depth", "sigma"))
def robust_depth(t):
    return series.robust_depth(t.series, K)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, {inside(1.2)} AS i, abs(({epoch()}) % 2) = 1 AS o FROM s),
m AS (SELECT k, {med('flux', 'NOT i')} AS base, stddev_pop(flux) FILTER (NOT i) AS sd, count(*) FILTER (NOT i) AS n_out, {med('flux', 'i AND o')} AS mo, count(*) FILTER (i AND o) AS n_odd, {med('flux', 'i AND NOT o')} AS me, count(*) FILTER (i AND NOT o) AS n_even FROM g GROUP BY k),
f AS (SELECT k, n_odd, n_even, n_out >= 10 AND n_odd >= 3 AND n_even >= 3 AS ok, base - mo AS a, base - me AS b, sd FROM m),
h AS (SELECT k, n_odd, n_even, CASE WHEN ok THEN a END AS depth_odd, CASE WHEN ok THEN b END AS depth_even, CASE WHEN ok AND sd > 0 THEN abs(a - b) / (sd * sqrt(1.0 / n_odd + 1.0 / n_even)) END AS z FROM f)
SELECT *, coalesce(z > 3, false) AS maybe_double FROM h""", ("depth_odd", "depth_even", "z"))
def odd_even(t):
    return series.odd_even(t.series, K)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, 0.01 * (1 + event_id % 9) AS e, {inside()} AS i, abs(({epoch()}) % 2) = 1 AS o FROM s), m AS (SELECT k, sum(flux / e / e) FILTER (i AND o) / sum(1 / e / e) FILTER (i AND o) AS odd, sum(flux / e / e) FILTER (i AND NOT o) / sum(1 / e / e) FILTER (i AND NOT o) AS even, sum(1 / e / e) FILTER (i AND o) AS wa, sum(1 / e / e) FILTER (i AND NOT o) AS wb FROM g GROUP BY k)
SELECT k, odd, even, (odd - even) / sqrt(1 / wa + 1 / wb) AS z FROM m""", ("odd", "even", "z"))
def odd_even_weighted(t):
    return series.odd_even_weighted(t.series.withColumn("flux_err", 0.01 * (1 + F.col("event_id") % 9)), K)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, {phase()} AS f FROM s), b AS (SELECT k, floor((f + 0.5) * 10)::BIGINT AS bin, {med('flux')} AS m, count(*) AS n FROM g WHERE abs(f) >= duration / period GROUP BY k, bin HAVING count(*) >= 2),
o AS (SELECT k, count(*) AS n_bins, stddev_pop(m) AS sd, {med('m')} AS mid, min(m) AS low, arg_min(bin, (m, bin)) AS deep FROM b GROUP BY k HAVING count(*) >= 4),
r AS (SELECT k, n_bins, (deep + 0.5) / 10 - 0.5 AS second_phase, mid - low AS depth, CASE WHEN sd > 0 THEN (mid - low) / sd ELSE 0.0 END AS sigma FROM o)
SELECT *, sigma > 1.5 AND abs(depth) * 1000 <= 900 AS detected FROM r""", ("second_phase", "depth", "sigma"))
def secondary_search(t):
    return series.secondary_search(t.series, K, bins=10, least=2, least_bins=4, detect=1.5, most_ppt=900)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, abs({mod(phase() + ' - 0.5 + 0.5', '1.0')} - 0.5) AS d, duration / period AS w FROM s) SELECT k, {med('flux', 'd > 1.5 * w / 2')} - {med('flux', 'd < 0.5 * w / 2')} AS depth, count(*) FILTER (d < 0.5 * w / 2) AS n_core FROM g GROUP BY k""", ("depth",))
def depth_at_half(t):
    return series.depth_at(t.series, K, 0.5)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, {phase()} AS f, duration / period / 2 AS h FROM s) SELECT k, {med('flux', 'abs(abs(f) - 0.25) < greatest(h, 0.05)')} - {med('flux', 'abs(f) < 0.5 * h')} AS dip FROM g GROUP BY k""", ("dip",))
def core_against_quadrature(t):
    return series.core_against_quadrature(t.series, K)


EVENTS = f"""{SERIES}, x AS (SELECT *, {epoch()} AS epoch, abs(t - t0 - ({epoch()}) * period) AS x FROM s), pe AS (
SELECT k, epoch, {med('flux', 'x > duration / 2')} - {med('flux', 'x < duration / 4')} AS depth, stddev_samp(flux) FILTER (x > duration / 2) / sqrt(count(*) FILTER (x < duration / 4)) AS depth_err, count(*) FILTER (x < duration / 4) AS n_in, count(*) FILTER (x > duration / 2) AS n_out
FROM x WHERE x < 1.5 * duration GROUP BY k, epoch HAVING count(*) FILTER (x < duration / 4) >= 1 AND count(*) FILTER (x > duration / 2) >= 2)"""
POOL = f"pl AS (SELECT k, count(*) AS n_events, {med('depth')} AS pooled, greatest({med('depth_err')} / sqrt(count(*)), stddev_samp(depth) / sqrt(count(*))) AS pooled_err FROM pe GROUP BY k)"


@R.add(f"""WITH {SERIES}, w AS (SELECT k, t, flux, t0, period * 4 AS period, 1.5::DOUBLE AS duration FROM s), d AS (SELECT k, duration, lead(t) OVER (PARTITION BY k ORDER BY t) - t AS d FROM w), c AS (SELECT k, coalesce({med('d', 'd < 0.05')}, {med('d')}) AS cadence, any_value(duration) AS duration FROM d GROUP BY k),
fl AS (SELECT k, CASE WHEN cadence > 0 THEN least(greatest(round_even(0.42 * duration / cadence, 0), 3), 5) ELSE 5 END AS least_core, CASE WHEN cadence > 0 THEN least(greatest(round_even(2.4 * duration / cadence, 0), 6), 10) ELSE 10 END AS least_local FROM c),
m AS (SELECT *, unnest(generate_series(ceil((t - t0 - 3 * duration) / period)::BIGINT, floor((t - t0 + 3 * duration) / period)::BIGINT)) AS epoch FROM w), x AS (SELECT *, t0 + epoch * period AS t_mid, abs(t - (t0 + epoch * period)) / duration AS x FROM m),
e AS (SELECT k, epoch, any_value(t_mid) AS t_mid, {med('flux', 'x > 1 AND x < 3')} AS base, {med('flux', 'x < 0.35')} AS low, count(*) FILTER (x < 0.35) AS n_core, count(*) FILTER (x > 1 AND x < 3) AS n_local FROM x GROUP BY k, epoch),
g AS (SELECT e.* FROM e JOIN fl ON e.k = fl.k WHERE n_core >= least_core AND n_local >= least_local),
sp AS (SELECT g.k, g.epoch, any_value(g.t_mid) AS t_mid, any_value((base - low) / base) AS depth, 1.4826 * {med('abs(flux - base)')} AS mad, any_value(n_core) AS n_core, any_value(base) AS base FROM g JOIN x ON g.k = x.k AND g.epoch = x.epoch WHERE x.x > 1 AND x.x < 3 GROUP BY g.k, g.epoch),
er AS (SELECT *, CASE WHEN mad > 0 THEN mad * 1.2533141373155003 / sqrt(n_core) / base END AS err FROM sp)
SELECT k, epoch, t_mid, depth, err, CASE WHEN err > 0 THEN depth / err END AS sigma, coalesce(depth / err >= 5 AND err > 0, false) AS seen FROM er""", ("t_mid", "depth", "err", "sigma"))
def adaptive_event_depths(t):
    """Events with enough points for their key's cadence; long ones, as the series are sparse."""
    return series.event_depths(t.series.withColumns({"period": F.col("period") * 4, "duration": F.lit(1.5)}), K)


@R.add(f"WITH {EVENTS} SELECT * FROM pe", ("depth", "depth_err"))
def per_event_depths(t):
    return series.per_event(t.series, K, least_in=1, least_out=2)


@R.add(f"WITH {EVENTS}, {POOL} SELECT * FROM pl", ("pooled", "pooled_err"))
def pooled_events(t):
    return series.pooled_events(series.per_event(t.series, K, least_in=1, least_out=2), K)


@R.add(f"WITH {EVENTS}, {POOL} SELECT pe.k, epoch, coalesce(depth < pooled / 2 AND pooled - depth > 5 * depth_err, false) AS absent FROM pe JOIN pl ON pe.k = pl.k")
def absent_events(t):
    e = series.per_event(t.series, K, least_in=1, least_out=2)
    return series.absent_events(e, series.pooled_events(e, K), K).select("k", "epoch", "absent")


@R.add(f"""WITH {SERIES}, m AS (SELECT k, t, t0, period * multiplier AS p, multiplier FROM s, (VALUES (0.5::DOUBLE), (1.0), (2.0)) v(multiplier)), f AS (SELECT k, multiplier, {phase('t', 'p')} AS f FROM m),
g AS (SELECT k, multiplier, coalesce(lead(f) OVER (PARTITION BY k, multiplier ORDER BY f), min(f) OVER (PARTITION BY k, multiplier) + 1) - f AS gap FROM f), o AS (SELECT k, multiplier, count(*) AS n, min(gap) AS gap FROM g GROUP BY k, multiplier)
SELECT *, CASE WHEN n >= 2 THEN 1 - pow(greatest(1 - n * gap, 0.0), n - 1) END AS p FROM o""", ("gap", "p"))
def circular_gap_test(t):
    return series.circular_gap(t.series, K)


@R.add(f"""WITH {SERIES}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t) > 1.0 THEN 1 ELSE 0 END AS new FROM s), x AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM g),
m AS (SELECT *, {med('flux')} OVER w AS med, count(*) OVER w AS n_all FROM x WINDOW w AS (PARTITION BY k, segment)), d AS (SELECT *, 1.4826 * {med('abs(flux - med)')} OVER (PARTITION BY k, segment) + 1e-6 AS sg FROM m)
SELECT k, segment, avg(t) AS t_mean, avg(flux) AS x_mean, stddev_samp(flux) / sqrt(count(*)) AS x_err, count(*) AS n FROM d WHERE n_all >= 3 AND abs(flux - med) < 4 * sg GROUP BY k, segment HAVING count(*) >= 3""", ("t_mean", "x_mean", "x_err"))
def session_means(t):
    return series.sessions(t.series, K, x="flux", gap=1.0)


ROLL = "RANGE BETWEEN 129599999999 PRECEDING AND 129600000000 FOLLOWING"


@R.add(f"""WITH {SERIES}, u AS (SELECT *, round_even(t * 86400000000.0, 0)::BIGINT AS us, CASE WHEN abs({phase()}) >= duration / period / 2 * 1.5 THEN flux END AS m FROM s),
r AS (SELECT *, CASE WHEN count(m) OVER w >= 2 THEN {med('m')} OVER w END AS tr FROM u WINDOW w AS (PARTITION BY k ORDER BY us {ROLL})),
n AS (SELECT *, last_value(CASE WHEN tr IS NOT NULL THEN {{'t': t, 'x': tr}} END IGNORE NULLS) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, first_value(CASE WHEN tr IS NOT NULL THEN {{'t': t, 'x': tr}} END IGNORE NULLS) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM r)
SELECT event_id, k, coalesce(tr, a.x + (b.x - a.x) * coalesce((t - a.t) / nullif(b.t - a.t, 0), 0.0), a.x, b.x) AS trend, flux / coalesce(tr, a.x + (b.x - a.x) * coalesce((t - a.t) / nullif(b.t - a.t, 0), 0.0), a.x, b.x) AS flat FROM n""", ("trend", "flat"))
def detrended(t):
    """Rolling median in time with events masked, interpolated across them."""
    return series.detrended(t.series, K, 3.0, least=2).select("event_id", "k", "trend", "flat")


@R.add(f"""WITH {SERIES} SELECT event_id, CASE WHEN count(flux) OVER w >= 3 THEN {med('flux')} OVER w END AS smooth FROM s WINDOW w AS (PARTITION BY k ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", ("smooth",))
def rolling_row_median(t):
    return series.rolling_rows(t.series, K, 5, least=3).select("event_id", "smooth")


@R.add(f"""WITH {SERIES}, d AS (SELECT *, flux - (lag(flux) OVER w + (lead(flux) OVER w - lag(flux) OVER w) * (t - lag(t) OVER w) / nullif(lead(t) OVER w - lag(t) OVER w, 0)) AS off FROM s WINDOW w AS (PARTITION BY k ORDER BY t)),
m AS (SELECT *, {med('off')} OVER (PARTITION BY k) AS m FROM d), c AS (SELECT *, 1.4826 * {med('abs(off - m)')} OVER (PARTITION BY k) AS sg FROM m) SELECT event_id, coalesce(abs(off - m) > 5 * sg, false) AS spike FROM c""")
def spike_mask(t):
    return series.spikes(t.series, K).select("event_id", "spike")


@R.add(f"""WITH {SERIES}, m AS (SELECT *, {med('flux')} OVER (PARTITION BY k, band) AS m FROM s), c AS (SELECT *, 1.4826 * {med('abs(flux - m)')} OVER (PARTITION BY k, band) AS sg FROM m) SELECT event_id, flux FROM c WHERE sg = 0 OR abs(flux - m) <= 2.5 * sg""", ("flux",))
def clipped_groups(t):
    return series.clip_groups(t.series, ["k", "band"], sigmas=2.5).select("event_id", "flux")


@R.add(f"""WITH {SERIES}, r AS (SELECT *, flux - {med('flux')} OVER (PARTITION BY k ORDER BY t ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS r FROM s), m AS (SELECT *, {med('r')} OVER (PARTITION BY k) AS m FROM r),
c AS (SELECT *, 1.4826 * {med('abs(r - m)')} OVER (PARTITION BY k) AS sg, row_number() OVER (PARTITION BY k ORDER BY t) AS n FROM m), z AS (SELECT *, (r - m) / sg AS z FROM c WHERE sg > 0), h AS (SELECT *, n - row_number() OVER (PARTITION BY k ORDER BY t) AS g FROM z WHERE z > 0.8)
SELECT k, min(t) AS start, max(t) AS stop, count(*) AS n, arg_max(t, (z, t)) AS peak_t, max(z) AS peak_z FROM h GROUP BY k, g HAVING count(*) >= 2""", ("start", "stop", "peak_t", "peak_z"))
def flares(t):
    return series.flares(t.series, K, sigmas=0.8, least_run=2)


@R.add(f"""WITH {SERIES}, d AS (SELECT k, lead(flux) OVER (PARTITION BY k ORDER BY t) - flux AS d FROM s), m AS (SELECT *, {med('d')} OVER (PARTITION BY k) AS m FROM d WHERE d IS NOT NULL) SELECT k, 1.4826 * {med('abs(d - m)')} / sqrt(2) AS scatter, count(*) AS n_steps FROM m GROUP BY k""", ("scatter",))
def point_scatter(t):
    return series.point_scatter(t.series, K)


@R.add(f"WITH {SERIES}, d AS (SELECT k, lead(t) OVER (PARTITION BY k ORDER BY t) - t AS d FROM s) SELECT k, {med('d')} AS cadence FROM d GROUP BY k", ("cadence",))
def median_cadence(t):
    return series.cadence(t.series, K)


@R.add(f"""WITH {SERIES}, a AS (SELECT *, coalesce(0.5 * (flux + lag(flux) OVER w) * (t - lag(t) OVER w), 0.0) AS a FROM s WINDOW w AS (PARTITION BY k ORDER BY t)) SELECT event_id, sum(a) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS integral FROM a""", ("integral",))
def running_integral(t):
    return series.running_integral(t.series, K).select("event_id", "integral")


@R.add(f"""WITH {SERIES}, p AS (SELECT *, floor((t - 19723) / 7)::BIGINT AS part FROM s) SELECT event_id, CASE WHEN max(part) OVER (PARTITION BY k) <> min(part) OVER (PARTITION BY k) THEN (dense_rank() OVER (PARTITION BY k ORDER BY part) - 1) % 2 ELSE ({epoch()}) % 2 END::INT AS half FROM p""")
def split_halves(t):
    return series.split_halves(t.series.withColumn("part", F.floor((F.col("t") - 19723) / 7)), K, "part").select("event_id", "half")


@R.add(f"""WITH {SERIES}, o AS (SELECT *, abs(({epoch()}) % 2) = 1 AS o FROM s), m AS (SELECT *, {med('flux', 'NOT o')} OVER (PARTITION BY k) AS ev, {med('flux', 'o')} OVER (PARTITION BY k) AS od FROM o),
a AS (SELECT k, count(*) FILTER (NOT o) AS n_even, count(*) FILTER (o) AS n_odd, any_value(ev - od) AS difference, 1.4826 * {med('abs(flux - CASE WHEN o THEN od ELSE ev END)')} AS sd FROM m GROUP BY k)
SELECT k, n_even, n_odd, difference, CASE WHEN sd > 0 AND n_odd > 0 AND n_even > 0 THEN abs(difference) / (sd * sqrt(1.0 / n_odd + 1.0 / n_even)) END AS z FROM a""", ("difference", "z"))
def alternation(t):
    rows = t.series.withColumn("epoch", S.epoch("t", "period", "t0"))
    return series.alternation(rows, K, "flux")


@R.add(f"""WITH {SERIES} SELECT k, floor(({phase()} + 0.5) * 20)::BIGINT AS bin, {med('flux')} AS flux, count(*) AS n, (floor(({phase()} + 0.5) * 20) + 0.5) / 20 - 0.5 AS centre FROM s GROUP BY ALL HAVING count(*) >= 2""", ("flux", "centre"))
def phase_bins(t):
    return series.phase_bins(t.series, K, 20)


FOLDED = f"fb AS (SELECT k, floor(({phase()} + 0.5) * 12)::BIGINT AS bin, {med('flux')} AS flux FROM s GROUP BY k, bin HAVING count(*) >= 2)"


@R.add(f"""WITH {SERIES}, {FOLDED}, b AS (SELECT *, {med('flux')} OVER (PARTITION BY k) AS base, min(flux) OVER (PARTITION BY k) AS low, arg_min(bin, (flux, bin)) OVER (PARTITION BY k) AS deep FROM fb),
r AS (SELECT *, bin - row_number() OVER (PARTITION BY k ORDER BY bin) AS g FROM b WHERE flux <= base - 0.5 * (base - low)) SELECT k, any_value(base) - any_value(low) AS depth, count(*) AS width_bins, any_value(deep) AS lowest FROM r GROUP BY k, g HAVING any_value(deep) BETWEEN min(bin) AND max(bin)""", ("depth",))
def primary_width(t):
    return series.primary_width(series.phase_bins(t.series, K, 12), K).withColumnRenamed("at", "lowest")


@R.add(f"""WITH {SERIES}, b AS (SELECT k, flux, len(list_filter([-0.5, -0.25, -0.1, 0.0, 0.1, 0.25, 0.5], lambda e: e <= {phase()})) AS bin FROM s) SELECT k, bin::INT AS bin, {med('flux')} AS y, count(*) AS n FROM b WHERE bin > 0 AND bin < 7 GROUP BY ALL HAVING count(*) >= 3""", ("y",))
def edge_bins(t):
    return series.edge_bins(t.series, K, S.phase("t", "period", "t0"), "flux", stats.edges_array([-0.5, -0.25, -0.1, 0.0, 0.1, 0.25, 0.5]))


def fine_edges(width: float) -> list[float]:
    """The edges of the next query: each fiftieth of a cycle, and steps of a tenth of 0.75 widths around 0 and 0.5."""
    fine = [round(c + i * 0.75 * width / 10, 9) for c in (0.0, 0.5) for i in range(-10, 11)]
    return sorted({round(-0.5 + i * 0.02, 9) for i in range(51)} | {x for x in fine if -0.5 < x < 0.5})


@R.add(f"""WITH {SERIES}, b AS (SELECT k, flux, len(list_filter({fine_edges(0.1)}, lambda e: e <= {phase()})) AS bin FROM s) SELECT k, bin::INT AS bin, {med('flux')} AS y, count(*) AS n FROM b WHERE bin > 0 AND bin < {len(fine_edges(0.1))} GROUP BY ALL HAVING count(*) >= 2""", ("y",))
def adaptive_bins(t):
    """Bins on edges that are fine around events."""
    return series.edge_bins(t.series, K, S.phase("t", "period", "t0"), "flux", series.adaptive_edges(F.lit(0.1)), 2)


@R.add(f"""WITH {SERIES}, b AS (SELECT *, floor((t - min(t) OVER (PARTITION BY k)) / 2)::BIGINT AS block FROM s) SELECT k, block, avg(t) AS t, avg(flux) AS flux, count(*) AS n FROM b GROUP BY k, block HAVING count(*) >= 0.8 * 2 / 0.5""", ("t", "flux"))
def downsampled(t):
    return series.downsampled(t.series, K, 2.0, 0.5)


@R.add(f"""WITH {SERIES}, e AS (SELECT *, 0.01 * (1 + event_id % 9) AS e FROM s) SELECT k, floor(t / 3)::BIGINT AS block, sum(t / e / e) / sum(1 / e / e) AS t, sum(flux / e / e) / sum(1 / e / e) AS flux, 1 / sqrt(sum(1 / e / e)) AS err, count(*) AS n FROM e GROUP BY ALL""", ("t", "flux", "err"))
def weighted_time_bins(t):
    return series.time_bins(t.series.withColumn("flux_err", 0.01 * (1 + F.col("event_id") % 9)), K, 3.0)


@R.add(f"""WITH {SERIES}, n AS (SELECT *, floor((row_number() OVER (PARTITION BY k ORDER BY t) - 1) / 5) AS b FROM s), m AS (SELECT k, b, avg(flux) AS m FROM n GROUP BY k, b HAVING count(*) = 5), a AS (SELECT k, stddev_pop(m) AS s, count(*) AS blocks FROM m GROUP BY k), w AS (SELECT k, stddev_pop(flux) AS w FROM s GROUP BY k)
SELECT a.k AS k, blocks, greatest(1.0, s / (w / sqrt(5.0))) AS beta FROM a JOIN w ON a.k = w.k""", ("beta",))
def red_noise(t):
    return series.red_noise(t.series, K, 5)


@R.add(f"WITH {SERIES} SELECT event_id, {phase()} * period * 24 AS hours FROM s WHERE abs({phase()} * period * 24) < 3 * duration * 24", ("hours",))
def event_zoom(t):
    return series.zoom(t.series, K).select("event_id", "hours")


@R.add(f"""WITH {SERIES}, m AS (SELECT *, abs({mod('t - t0 + period / 2', 'period')} - period / 2) AS x1, abs({mod('t - (t0 + period / 2) + period / 2', 'period')} - period / 2) AS x2 FROM s)
SELECT event_id, 0.3 * least(greatest((duration / 2 - x1) / (0.4 * duration / 2), 0.0), 1.0) + 0.1 * least(greatest((duration / 2 - x2) / (0.4 * duration / 2), 0.0), 1.0) AS dimming FROM m""", ("dimming",))
def injected_model(t):
    return t.series.select("event_id", S.trapezoid("t", "period", "t0", "duration", 0.4, F.lit(0.3), F.lit(0.1)).alias("dimming"))


@R.add(f"""WITH {SERIES}, e AS (SELECT *, pow(10, -0.4 * ((20 - ln(v)) - quantile_cont(20 - ln(v), 0.5) OVER (PARTITION BY k, band))) AS f, 0.01 + 0.01 * (event_id % 25) AS me FROM s WHERE event_id % 7 > 0 AND 0.01 + 0.01 * (event_id % 25) <= 0.2), m AS (SELECT *, {med('f')} OVER (PARTITION BY k) AS m FROM e), c AS (SELECT *, 1.4826 * {med('abs(f - m)')} OVER (PARTITION BY k) AS sg FROM m)
SELECT event_id, f AS flux, f * me / 1.0857 AS flux_err FROM c WHERE f < 1 + greatest(5 * sg, 0.05)""", ("flux", "flux_err"))
def relative_flux(t):
    # a flux of zero has an infinite magnitude, which counts in its band's median
    mag = F.when(F.col("v") == 0, F.lit(float("inf"))).otherwise(20 - F.log("v"))
    rows = t.series.withColumns({"mag": mag, "magerr": 0.01 + 0.01 * (F.col("event_id") % 25), "catflags": (F.col("event_id") % 7 == 0).cast("int")}).drop("flux", "flux_err")
    return series.relative_flux(rows, K, "band").select("event_id", "flux", "flux_err")


# -- kernels ----------------------------------------------------------------------------------------------------------

TRIALS = [1.1, 1.7, 2.01, 2.32, 2.63]


@R.add()
def box_least_squares(t):
    """The grouped numpy search over 15,000 periods and ten durations (no SQL form of its grid: a brute force in the tests)."""
    return boxes.box_least_squares(t.series, "k").select("k", "n", *[F.round(c, 6).alias(c) for c in ("period", "duration", "depth", "snr")])


@R.add(f"""WITH {SERIES}, b AS (SELECT k, p, floor({mod('t / p', '1.0')} * 10)::BIGINT AS bin, sum(400.0) AS w, sum(400.0 * flux) AS wy FROM s, (VALUES {", ".join(f"({p}::DOUBLE)" for p in TRIALS)}) v(p) GROUP BY ALL),
u AS (SELECT * FROM b UNION ALL SELECT k, p, bin + 10, w, wy FROM b WHERE bin < 1), x AS (SELECT *, sum(w) OVER bx AS iw, sum(wy) OVER bx AS iy, sum(w) FILTER (bin < 10) OVER ev AS aw, sum(wy) FILTER (bin < 10) OVER ev AS ay FROM u WINDOW ev AS (PARTITION BY k, p), bx AS (PARTITION BY k, p ORDER BY bin RANGE BETWEEN CURRENT ROW AND 1 FOLLOWING)),
d AS (SELECT k, p, bin, (ay - iy) / (aw - iw) - iy / iw AS depth, ((ay - iy) / (aw - iw) - iy / iw) / sqrt(1 / iw + 1 / (aw - iw)) AS snr FROM x WHERE bin < 10 AND aw - iw > 1e-9 * aw),
g AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(snr, 9) DESC, p, bin) AS n FROM d) SELECT k, p AS period, bin * p / 10 AS start, depth, snr FROM g WHERE n = 1""", ("period", "start", "depth", "snr"))
def box_scan(t):
    """The same search by sums alone."""
    return kernels.box_scan(t.series, K, TRIALS, bins=10, width_bins=2)


@R.add(f"""WITH {SERIES}, c AS (SELECT *, flux - avg(flux) OVER (PARTITION BY k) AS y FROM s), a AS (SELECT k, f, y, cos(2 * pi() * f * t) AS c, sin(2 * pi() * f * t) AS n FROM c, (VALUES (0.11::DOUBLE), (0.23), (0.41), (0.77)) v(f)),
m AS (SELECT k, f, sum(y * c) AS yc, sum(y * n) AS ys, sum(c * c) AS cc, sum(n * n) AS ss, sum(c * n) AS cs, sum(y * y) AS yy FROM a GROUP BY k, f), p AS (SELECT k, f, (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (cc * ss - cs * cs) / yy AS power FROM m)
SELECT k, f AS frequency, power FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(power, 9) DESC, f) AS n FROM p) WHERE n = 1""", ("power",))
def lomb_scargle(t):
    return kernels.lomb_scargle(t.series, K, [0.11, 0.23, 0.41, 0.77])


@R.add(f"""WITH {SERIES}, j AS (SELECT k, flux, g.j AS j, abs({phase('t', 'period', '(t0 + g.j * period / 20)')}) < duration / period / 2 AS i FROM s, generate_series(0, 19) g(j)),
m AS (SELECT k, j, sum(400.0) FILTER (i) AS a, sum(400.0 * flux) FILTER (i) AS b, sum(400.0) FILTER (NOT i) AS c, sum(400.0 * flux) FILTER (NOT i) AS d FROM j GROUP BY k, j), z AS (SELECT k, j, d / c - b / a AS depth, (d / c - b / a) / sqrt(1 / a + 1 / c) AS z FROM m)
SELECT o.k AS k, o.depth AS depth, o.z AS z, (1 + count(r.z) FILTER (r.z >= o.z)) / (1 + count(r.z)) AS p_value FROM z o LEFT JOIN z r ON o.k = r.k AND r.j > 0 WHERE o.j = 0 GROUP BY o.k, o.depth, o.z""", ("depth", "z", "p_value"))
def fold_test(t):
    return kernels.fold_test(t.series, K, 20)


@R.add(f"""WITH {SERIES}, j AS (SELECT k, flux, g.j AS j, g.j * duration / 5 AS o, abs({phase('t', 'period', '(t0 + g.j * duration / 5)')}) < duration / period / 2 * 0.5 AS i FROM s, generate_series(-5, 5) g(j)), m AS (SELECT k, j, o, {med('flux')} AS m FROM j WHERE i GROUP BY k, j, o HAVING count(*) >= 3)
SELECT k, o AS shift, m AS flux FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY m, abs(j), j) AS n FROM m) WHERE n = 1""", ("shift", "flux"))
def refined_t0(t):
    return kernels.refine_t0(t.series, K, 11).withColumnRenamed("offset", "shift")


@R.add()
def event_times(t):
    """Template timing of each event (grouped numpy), 301 shifts and a gain of 25 at least."""
    return kernels.event_times(t.lights, "band", shifts=301, widths=0.75, least_gain=25.0).select("band", "epoch", *[F.round(c, 5).alias(c) for c in ("time", "time_err")])


@R.add()
def ephemeris_lines(t):
    """Noise-aware lines and their hold-out tests."""
    times = kernels.event_times(t.lights, "band", shifts=301, widths=0.75, least_gain=25.0).withColumn("sector", F.floor((F.col("time") - 19723) / 7))
    fits = kernels.fit_lines(times, "band")
    return fits.select("band", "n", "n_tests", *[F.round(c, 4).alias(c) for c in ("t0", "period")])


@R.add(f"""WITH {SERIES}, r AS (SELECT k, period, flux AS y, 400.0 AS w, sin(2 * pi() * (t - t0) / period) AS s, cos(2 * pi() * (t - t0) / period) AS c FROM s), m AS (SELECT k, count(*) AS n, sum(w) AS w, sum(w*s) AS ws, sum(w*c) AS wc, sum(w*s*s) AS ss, sum(w*s*c) AS sc, sum(w*c*c) AS cc, sum(w*y) AS wy, sum(w*s*y) AS sy, sum(w*c*y) AS cy FROM r GROUP BY k),
d AS (SELECT *, ss*(cc*w-wc*wc) - sc*(sc*w-wc*ws) + ws*(sc*wc-cc*ws) AS d, sy*(cc*w-wc*wc) - sc*(cy*w-wc*wy) + ws*(cy*wc-cc*wy) AS da, ss*(cy*w-wc*wy) - sy*(sc*w-wc*ws) + ws*(sc*wy-cy*ws) AS db, ss*(cc*wy-cy*wc) - sc*(sc*wy-cy*ws) + sy*(sc*wc-cc*ws) AS dg FROM m)
SELECT k, n, sqrt((da/d)*(da/d) + (db/d)*(db/d)) AS k_amp, dg/d AS gamma, da/d*sy + db/d*cy + dg/d*wy - wy*wy/w AS delta_chi2 FROM d""", ("k_amp", "gamma", "delta_chi2"), 4)
def sinusoid_fit(t):
    got = kernels.sinusoid_fit(t.series.withColumnRenamed("k", "id"), ["id"], y="flux", err="flux_err")
    return got.select(F.col("id").alias("k"), "n", F.col("k").alias("k_amp"), "gamma", "delta_chi2")


@R.add(f"""WITH {SERIES}, r AS (SELECT k, p, flux AS y, 400.0 AS w, sin(2 * pi() * t / p) AS s, cos(2 * pi() * t / p) AS c FROM s, (VALUES (3.0::DOUBLE), (5.0), (8.0), (13.0)) v(p)), m AS (SELECT k, p, sum(w) AS w, sum(w*s) AS ws, sum(w*c) AS wc, sum(w*s*s) AS ss, sum(w*s*c) AS sc, sum(w*c*c) AS cc, sum(w*y) AS wy, sum(w*s*y) AS sy, sum(w*c*y) AS cy FROM r GROUP BY k, p),
d AS (SELECT *, ss*(cc*w-wc*wc) - sc*(sc*w-wc*ws) + ws*(sc*wc-cc*ws) AS d, sy*(cc*w-wc*wc) - sc*(cy*w-wc*wy) + ws*(cy*wc-cc*wy) AS da, ss*(cy*w-wc*wy) - sy*(sc*w-wc*ws) + ws*(sc*wy-cy*ws) AS db, ss*(cc*wy-cy*wc) - sc*(sc*wy-cy*ws) + sy*(sc*wc-cc*ws) AS dg FROM m),
g AS (SELECT k, p, da/d*sy + db/d*cy + dg/d*wy - wy*wy/w AS gain FROM d), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(gain, 6) DESC, p) AS n FROM g) SELECT k, p AS period, gain AS delta_chi2 FROM o WHERE n = 1""", ("delta_chi2",), 4)
def third_body_grid(t):
    got = kernels.third_body_grid(t.series.select(F.col("k").alias("id"), "t", "flux", "flux_err"), ["id"], [3.0, 5.0, 8.0, 13.0], "t", "flux", "flux_err")
    return got.select(F.col("id").alias("k"), "period", "delta_chi2")


@R.add(f"""WITH {SERIES}, f AS (SELECT k, min(t) AS t0, any_value(period) AS period, 0.01::DOUBLE AS e0, 0.001::DOUBLE AS ep FROM s GROUP BY k), w AS (SELECT * FROM (VALUES (1, 19730.0::DOUBLE, 19735.0::DOUBLE), (2, 19740.0, 19743.0)) v(win, lo, hi)), c AS (SELECT *, ceil((lo - t0) / period)::BIGINT AS a, floor((hi - t0) / period)::BIGINT AS b FROM f, w)
SELECT k, win AS "window", g.n AS cycle, t0 + g.n * period AS time, sqrt(e0 * e0 + g.n * ep * g.n * ep) AS sigma FROM c, LATERAL (SELECT unnest(generate_series(a, b)) AS n) g""", ("time", "sigma"))
def predicted_times(t):
    fits = t.series.groupBy("k").agg(F.min("t").alias("t0"), F.first("period").alias("period")).withColumns({"t0_err": F.lit(0.01), "period_err": F.lit(0.001)})
    windows = t.spark.createDataFrame([(1, 19730.0, 19735.0), (2, 19740.0, 19743.0)], "window int, lo double, hi double")
    return kernels.predict_times(fits, windows, ["k"])


@R.add()
def connected_parts(t):
    """Greedy phase connection of weekly mean times."""
    parts = t.series.groupBy("k", F.floor((F.col("t") - 19723) / 7).alias("part")).agg(F.min("t").alias("time"), F.first("period").alias("period")).withColumns({"time_err": F.lit(0.01), "period_err": F.lit(0.02)})
    return kernels.connect_parts(parts, "k")


@R.add(f"""WITH i AS (SELECT DISTINCT user_id AS id FROM events), r AS (SELECT id, k, 1.7::DOUBLE + (id % 7) * 0.31::DOUBLE AS period, 0.3::DOUBLE * pow(13.0::DOUBLE / 0.3, ('0x' || substr(md5('5:' || id || ':' || k), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0) AS trial FROM i, (SELECT unnest(range(20))::INT AS k))
SELECT id, k, trial FROM r WHERE len(list_filter([1.0, 2.0, 3.0, 4.0, 1.0 / 2, 3.0 / 2, 1.0 / 3, 2.0 / 3, 4.0 / 3, 1.0 / 4, 3.0 / 4], lambda x: abs(trial / period / x - 1) < 0.02)) = 0""", ("trial",))
def control_periods(t):
    keys = t.series.groupBy("k").agg(F.first("period").alias("period"))
    return kernels.control_periods(keys.withColumnRenamed("k", "id"), "id", 20, 5).select("id", "k", "trial")


@R.add()
def difference_images(t):
    """A cube of 5 x 5 pixels from the series: the dip sits in one pixel."""
    pixel = F.explode(F.sequence(F.lit(0), F.lit(24))).alias("p")
    cube = t.series.select("*", pixel).withColumns({"row": F.floor(F.col("p") / 5).cast("int"), "col": (F.col("p") % 5).cast("int")})
    dip = F.when(S.in_event("t", "period", "t0", "duration") & (F.col("p") == 12), 0.5).otherwise(0.0)
    cube = cube.withColumn("pix", 1.0 + 0.01 * (F.col("event_id") % 7) - dip)
    return kernels.difference_image(cube, K, y="pix").select("k", "peak_row", "peak_col", F.round("peak", 6).alias("peak"), F.round("compactness", 6).alias("compactness"))
