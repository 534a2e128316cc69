"""Hand-checkable cases of the operators, recovery of planted signals, and plan shapes."""

import contextlib
import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions import ladders as L
from orrery.functions import scalars as S
from orrery.functions import stats
from orrery.operators import boxes, kernels, matching, sampling, series, survey
from orrery.operators import relational as rel
from orrery.sources import text
from orrery.streaming import gaps


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_wilson(spark):
    for k, n, lo, hi in ((5, 10, 0.2366, 0.7634), (0, 10, 0, 0.2775), (10, 10, 0.7225, 1), (0, 0, 0, 1)):
        got = spark.range(1).select(*[c.alias(x) for c, x in zip(stats.wilson(F.lit(k), F.lit(n)), "ab")]).first()
        assert got.a == pytest.approx(lo, abs=1e-4) and got.b == pytest.approx(hi, abs=1e-4)


def test_edges_go_to_their_side(spark):
    edges = stats.edges_array([1.0, 2.0])
    assert [one(spark, stats.bin_below(F.lit(x), edges)) for x in (1.0, -5.0, 99.0, 2.0)] == [0, 0, 2, 1]
    assert [one(spark, stats.bin_upto(F.lit(x), edges)) for x in (1.0, -5.0, 99.0)] == [1, 0, 2]


def test_audit_funnel_is_nested(spark):
    people = spark.createDataFrame([(i, float(i)) for i in range(20)], "key long, x double")
    ids = lambda *k: spark.createDataFrame([(i,) for i in k], "key long")
    got = survey.stratified_audit(people, "key", "x", 5, ids(*range(10), 999), usable=ids(*range(9), 999), passed=ids(1, 2, 3, 12)).agg(F.sum("sampled").alias("a"), F.sum("usable").alias("b"), F.sum("passed").alias("c")).first()
    assert tuple(got) == (10, 9, 3)


def test_shards_are_disjoint_and_cover(spark):
    df = spark.range(240).withColumnRenamed("id", "k")
    parts = [{r.k for r in sampling.shard(df, "k", i, 6).collect()} for i in range(6)]
    assert all(len(p) == 40 for p in parts) and set().union(*parts) == set(range(240))
    hashed = [{r.k for r in sampling.shard_by_hash(df, "k", i, 6).collect()} for i in range(6)]
    assert sum(map(len, hashed)) == 240 and set().union(*hashed) == set(range(240))
    assert sampling.parse_shard("2/8") == (2, 8)
    for bad in ("8/8", "-1/4", "1/0"):
        with pytest.raises((ValueError, ZeroDivisionError)):
            sampling.parse_shard(bad)


def test_stratified_sample_and_shortfall(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.rand(3).alias("x"))
    got = sampling.stratified(df, "k", "x", 5, 52, 1).collect()
    assert len(got) == 52 and len({r.k for r in got}) == 52
    small = sampling.stratified(df.limit(8), "k", "x", 5, 52, 1)
    assert {r.stratum for r in sampling.shortfall(small, 5, 52).collect()} == {0, 1, 2, 3, 4}


def test_union_by_key(spark):
    base = spark.createDataFrame([(1, 10), (2, 20)], "k long, v long")
    other = spark.createDataFrame([(2, 99), (3, 30), (3, 31)], "k long, v long")
    got = rel.union_by_key(base, [other], ["k"])
    assert {r.k: r.v for r in got.collect()} == {1: 10, 2: 20, 3: 30}
    assert sorted(map(tuple, rel.union_by_key(got, [other], ["k"]).collect())) == sorted(map(tuple, got.collect()))
    roles = spark.createDataFrame([(1, "control")], "k long, role string")
    more = spark.createDataFrame([(1, "control"), (1, "candidate")], "k long, role string")
    assert rel.union_by_key(roles, [more], ["k", "role"]).count() == 2


def test_nearest_match(spark):
    stars = spark.createDataFrame([(5000 + i, 10 + 0.01 * i, 20.0) for i in range(10)], "id long, ra double, dec double")
    as_deg = 1 / 3600
    hits = spark.createDataFrame(
        [(1, 10.02 + 3 * as_deg, 20.0, "far"), (2, 10.02 + as_deg, 20.0, "near"), (3, 10.04 + 9 * as_deg, 20.0, "out"), (4, 10.07, 20.0 + 2 * as_deg, "seven")], "n long, ra2 double, dec2 double, name string"
    )
    got = {r.id: r for r in matching.nearest(stars, hits, 5.0, "id", "n").collect()}
    assert set(got) == {5002, 5007} and got[5002].name == "near" and got[5002].sep_arcsec == pytest.approx(math.cos(math.radians(20)), rel=1e-4)


def test_positions_across_zero_and_poles(spark):
    rng = np.random.default_rng(2)
    a = [(i, float(r), float(d)) for i, (r, d) in enumerate(zip(rng.uniform(-0.02, 0.02, 80) % 360, rng.uniform(-0.02, 0.02, 80)))]
    a += [(100 + i, float(r), float(d)) for i, (r, d) in enumerate(zip(rng.uniform(0, 360, 80), rng.uniform(89.97, 90, 80)))]
    left = spark.createDataFrame(a, "id long, ra double, dec double")
    got = {(r.id, r.id2) for r in matching.within(left, left.select(*[F.col(c).alias(f"{c}2") for c in left.columns]), 40.0).collect()}

    def sep(p, q):
        b, c = np.radians(p[2]), np.radians(q[2])
        h = np.sin((c - b) / 2) ** 2 + np.cos(b) * np.cos(c) * np.sin(np.radians(q[1] - p[1]) / 2) ** 2
        return np.degrees(2 * np.arcsin(np.sqrt(h))) * 3600

    assert got == {(p[0], q[0]) for p in a for q in a if sep(p, q) <= 40.0}


def test_positional_join_has_no_nested_loop(spark):
    df = spark.range(9).select("id", F.rand().alias("ra"), F.rand().alias("dec"))
    plan = matching.within(df, df.select(*[F.col(c).alias(f"{c}2") for c in df.columns]), 5.0)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        plan.explain("formatted")
    assert "NestedLoop" not in out.getvalue() and "Cartesian" not in out.getvalue() and "Python" not in out.getvalue()


def test_series_operators_stay_in_the_jvm(spark):
    df = spark.range(9).select((F.col("id") % 2).alias("k"), F.rand().alias("t"), F.rand().alias("flux"), F.lit(2.0).alias("period"), F.lit(0.0).alias("t0"), F.lit(0.1).alias("duration"))
    for plan in (series.segment_quality(df, ["k"]), series.robust_depth(df, ["k"]), series.coverage(df, ["k"]), series.detrended(df, ["k"], 1.0)):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            plan.explain("formatted")
        assert "Python" not in out.getvalue() and "Pandas" not in out.getvalue()


def test_outcome(spark):
    got = [one(spark, S.outcome(F.lit(True), F.lit(p).cast("double"), F.lit(3.0))) for p in (3.01, 1.5, 6.0, 4.1, None)]
    assert got == ["exact", "alias", "alias", "wrong", "wrong"] and one(spark, S.outcome(F.lit(False), F.lit(3.0), F.lit(3.0))) == "missed"


def test_neighbours(spark):
    rows = spark.createDataFrame([(1, 12.5, 4.0), (2, 12.5, 40.0), (3, 20.0, 3.0)], "neighbour long, mag double, sep_arcsec double")
    edges = rows.select(F.lit(7).alias("k"), "neighbour", S.required_depth(F.lit(0.02), F.lit(12.0), F.col("mag")).alias("required_depth"), "sep_arcsec", F.lit(3.0).alias("offset"), F.lit(0.0).alias("tolerance"))
    got = survey.sky_assessment(edges, "k", (6.0,)).first()
    assert (got.bright, got.viable, got.closest) == (2, 1, 1) and one(spark, L.neighbour_status(F.lit(got.viable), F.lit(got.unseparable))) == "UNSEPARABLE_NEIGHBOUR"


def test_grades(spark):
    def graded(minutes, source="SPOC", covered=True):
        return one(spark, L.graded_outcome(F.lit(covered), F.lit(100.0), F.lit(4.0), F.lit(100 + minutes / 1440), F.lit(3.0), F.lit(source)))

    assert [graded(14.9), graded(15.1), graded(16.0, "QLP"), graded(16.0), graded(1.0, covered=False)] == ["RECOVERED", "INCONSISTENT", "RECOVERED", "INCONSISTENT", "INSUFFICIENT_DATA"]


def test_alias_hypotheses(spark):
    table = matching.hypotheses()
    assert len(table) == 72 and table[0][1:] == (1.0, 0.0, 1) and all(h[2] == 0 for h in table[:8])
    rows = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (1.0, 0.5), (5.4321, 7.7777)], "true double, found double")
    got = [r.hypothesis for r in matching.explain(rows, "true", "found").collect()]
    assert [g and round(g.multiplier, 4) for g in got[:3]] == [0.3333, 1.0, 2.0] and got[3] is None


def test_same_object(spark):
    a = 1 / 3600
    rows = [(1, 1, 10.0, 0.0)] * 3 + [(1, 2, 10.0 + 0.2 * a, 0.0)] * 3 + [(1, 3, 10.0 + 2.5 * a, 0.0)] * 3
    points = spark.createDataFrame(rows, "k long, oid long, ra double, dec double").withColumns({"tra": F.lit(10.0), "tdec": F.lit(0.0)})
    assert {r.oid for r in matching.same_object(points, "k", "oid", "ra", "dec", "tra", "tdec").collect()} == {1, 2}


def test_relative_flux(spark):
    rng = np.random.default_rng(0)
    rows = [(1, b, float(15 + j + rng.normal(0, 0.005)), 0.01, int(i == 0)) for j, b in enumerate("gr") for i in range(60)]
    got = series.relative_flux(spark.createDataFrame(rows, "k long, band string, mag double, magerr double, catflags int"), ["k"], "band").collect()
    assert len(got) == 118 and abs(np.median([r.flux for r in got]) - 1) < 0.01


def light_curve(period=2.37, depth=0.08, noise=0.002, days=27.0, step=0.01, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(0, days, step)
    x = np.abs((t - 0.7 + period / 2) % period - period / 2)
    return t, 1 - depth * np.clip((0.1 - x) / 0.03, 0, 1) + rng.normal(0, noise, len(t))


def frame(spark, curves):
    rows = [(k, float(a), float(b), 0.002) for k, (t, y) in curves.items() for a, b in zip(t, y)]
    return spark.createDataFrame(rows, "k long, t double, flux double, flux_err double")


def test_box_search_recovers_a_period(spark):
    curves = {1: light_curve(), 2: light_curve(depth=0.0)}
    got = {r.k: r for r in boxes.box_least_squares(frame(spark, curves), "k", n_periods=1500, shortest=0.5, durations=(0.1, 0.2)).collect()}
    assert one(spark, S.outcome(F.lit(True), F.lit(got[1].period), F.lit(2.37))) in ("exact", "alias")
    assert got[1].depth == pytest.approx(0.07, abs=0.02) and got[1].snr > 20 > got[2].snr


def test_both_box_searches_agree(spark):
    trials = [2.1, 2.25, 2.37, 2.5]
    got = kernels.box_scan(frame(spark, {1: light_curve()}), ["k"], trials, bins=60, width_bins=5).first()
    assert got.period == 2.37 and got.depth == pytest.approx(0.06, abs=0.02)


def test_timing_and_holdout(spark):
    t0, p, out = 0.7, 2.37, []
    for start in (10.0, 400.0, 800.0):
        t, _ = light_curve(days=25)
        t = t + start
        x = np.abs((t - t0 + p / 2) % p - p / 2)
        out.append((t, 1 - 0.08 * np.clip((0.1 - x) / 0.03, 0, 1) + np.random.default_rng(int(start)).normal(0, 0.002, len(t))))
    curve = (np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out]))
    df = frame(spark, {1: curve}).withColumns({"period": F.lit(p), "t0": F.lit(t0), "duration": F.lit(0.2)})
    times = kernels.event_times(df, "k", least_gain=25.0).withColumn("sector", F.floor(F.col("time") / 200))
    rows = times.collect()
    assert len(rows) > 25 and max(abs(r.time - t0 - r.epoch * p) for r in rows) < 0.01
    fit = kernels.fit_lines(times, "k").first()
    assert fit.period == pytest.approx(p, abs=5 * fit.period_err + 1e-5) and fit.n_tests == 3
    assert one(spark, L.holdout_status(F.lit(fit.least_p), F.lit(fit.n_tests))) == "PASS"
    drift = times.withColumn("time", F.col("time") + 3e-6 * F.pow("epoch", 2) * F.when(F.col("sector") == 4, 1.0).otherwise(0.0))
    bent = kernels.fit_lines(drift, "k").first()
    assert bent.shared > 10 * max(fit.shared, 1e-6) or bent.least_p < 0.01


def test_tails():
    assert kernels.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9) and kernels.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert kernels.aperture_share(0.0, 2.0, 1.0) == pytest.approx(1 - math.exp(-2), abs=1e-9) and kernels.aperture_share(50.0, 2.0, 1.0) < 1e-9


def test_orbits(spark):
    for m, e in ((0.3, 0.1), (2.5, 0.7), (-1.2, 0.5)):
        x = one(spark, S.kepler_anomaly(F.lit(m), F.lit(e)))
        assert x - e * math.sin(x) == pytest.approx(m, abs=1e-12)
    m2 = one(spark, S.least_companion(F.lit(0.3), F.lit(1.2)))
    assert m2**3 / (1.2 + m2) ** 2 == pytest.approx(0.3, rel=1e-9)


def test_same_value(spark):
    cases = [(None, "", True), ("--", "nan", True), ("1.0", "1.0000001", True), ("1.0", "1.1", False), (" a", "a ", True), ("a", None, False)]
    assert [one(spark, S.same_value(F.lit(a), F.lit(b))) for a, b, _ in cases] == [c for _, _, c in cases]


def test_tsv(spark, tmp_path):
    lines = ["# about", "", "A\tB \tC", "\tdeg\t", "---\t---\t---", "1\t 2.5\tx", "2\t\ty", "short", "3\t-1\t--"]
    (tmp_path / "t.tsv").write_text("\n".join(lines))
    got = text.read_tsv(spark, str(tmp_path / "t.tsv"))
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "double", "string"] and sorted(map(tuple, got.collect())) == [(1.0, 2.5, "x"), (2.0, None, "y"), (3.0, -1.0, "--")]
    with pytest.raises(ValueError):
        text.tsv_table(spark.createDataFrame([("error",)], "value string"))


def test_tsv_answer(spark):
    answer = lambda *rows: text.tsv_answer(spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1))
    assert answer("# only", "") is None and answer("#INFO Error=none found", "A\tB") is None and answer("Content-Type: text/plain") is None
    assert sorted(map(tuple, answer("# x", "A\tB", "\tdeg", "-\t-", "1\t2", "3\t").collect())) == [("1", "2"), ("3", None)]


def test_sources(spark, tmp_path):
    ids = text.id_list(spark.createDataFrame([("TIC 12345 and 678901, not 12",)], "value string"))
    assert {r.id for r in ids.collect()} == {12345, 678901}
    log = spark.createDataFrame([("2026-01-02 03:04:05 ERROR lost",), ("[2026-01-02 03:04:06] fine",), ("noise",)], "value string")
    got = text.log_records(log)
    assert [(r.level, r.message) for r in got.orderBy("at").collect()] == [("ERROR", "lost"), ("INFO", "fine")] and text.activity(got).first().errors == 1
    path = str(tmp_path / "results")
    wanted = spark.range(5).withColumnRenamed("id", "k")
    assert text.resume(wanted, path, ["k"], "k long").count() == 5
    text.append(wanted.filter("k < 3"), path)
    assert {r.k for r in text.resume(wanted, path, ["k"], "k long").collect()} == {3, 4}
    with pytest.raises(RuntimeError):
        text.write_checked(wanted, str(tmp_path / "no"), F.col("k") < 2)
    assert text.optional(spark, str(tmp_path / "no"), "k long", "parquet").count() == 0


def test_streamed_sessions_equal_batch(spark, tmp_path, data):
    rows = spark.read.parquet(f"{data}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("at"), "value").filter("user_id < 4")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    gaps.run_to_table(gaps.gap_sessions(stream, "user_id", "at", "value"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("user_id", "start", "n").collect()}
    batch = {tuple(r) for r in gaps.gap_sessions(rows, "user_id", "at", "value").select("user_id", "start", "n").collect()}
    assert got and got <= batch and len(batch - got) <= 3 * 8


def test_phase_connection(spark):
    rows = [(1, i, 100 + n * 2.5, 0.001, 2.5001, 0.0005) for i, n in enumerate((0, 3, 40, 300))] + [(1, 9, 100 + 5000.4 * 2.5, 0.001, 2.5001, 0.0005)]
    got = {r.part: (r.cycle, r.joined) for r in kernels.connect_parts(spark.createDataFrame(rows, "k long, part long, time double, time_err double, period double, period_err double"), "k").collect()}
    assert [got[i][0] for i in range(4)] == [0, 3, 40, 300] and not got[9][1]


def test_difference_image(spark, data):
    from orrery.plans import catalog

    got = catalog.queries()["difference_images"](spark, data).collect()
    assert sum((r.peak_row, r.peak_col) == (2, 2) for r in got) >= 0.8 * len(got)


def event_depths_brute(t, f, period, t0, dur):
    """The events of one object, point by point."""
    steps = np.diff(np.sort(t))
    fine = steps[steps < 0.05]
    step = np.median(fine if len(fine) else steps) if len(steps) else 0
    least = (min(max(np.rint(0.7 * 0.6 * dur / step), 3), 5), min(max(np.rint(2.4 * dur / step), 6), 10)) if step > 0 else (5, 10)
    out = {}
    for e in range(-50, 51):
        x = np.abs(t - t0 - e * period) / dur
        core, side = f[x < 0.35], f[(x > 1) & (x < 3)]
        if len(core) >= least[0] and len(side) >= least[1]:
            base = np.median(side)
            depth, mad = 1 - np.median(core) / base, 1.4826 * np.median(np.abs(side - base))
            err = mad * np.sqrt(np.pi / 2 / len(core)) / base if mad > 0 else None
            out[e] = (depth, err, bool(err) and depth / err >= 5)
    return out


def test_event_depths(spark):
    rng, rows, want = np.random.default_rng(5), [], {}
    for key, step, period, dur, noise in [(1, 0.02, 2.3, 0.2, 1e-3), (2, 0.03, 0.9, 0.12, 5e-3), (3, 0.2, 3.1, 1.4, 2e-3), (4, 0.02, 1.7, 0.15, 0.0), (5, 0.02, 5.0, 0.02, 1e-3)]:
        t = np.sort(rng.choice(np.arange(0, 25, step), int(25 / step * 0.9), replace=False) + rng.uniform(0, step / 9, int(25 / step * 0.9)))
        f = 1 + noise * rng.normal(size=len(t))
        f[np.abs((t - 1.1 + period / 2) % period - period / 2) < dur / 2] -= 0.02
        rows += [(key, float(a), float(b), period, 1.1, dur) for a, b in zip(t, f)]
        want |= {(key, e): v for e, v in event_depths_brute(t, f, period, 1.1, dur).items()}
    schema = "id long, t double, flux double, period double, t0 double, duration double"
    df = spark.createDataFrame([*rows, (6, 0.0, 1.0, 1.0, 0.0, 0.1), (7, None, 1.0, 1.0, 0.0, 0.1), (8, 0.0, None, 1.0, 0.0, 0.1)], schema)
    got = {(r.id, r.epoch): (r.depth, r.err, r.seen) for r in series.event_depths(df, ["id"]).collect()}
    assert got.keys() == want.keys() and {k for k, _ in got} == {1, 2, 3, 4}
    for k, (depth, err, seen) in want.items():
        assert got[k][0] == pytest.approx(depth, abs=1e-12) and got[k][1] == (err if err is None else pytest.approx(err, rel=1e-9)) and got[k][2] == seen
    assert series.event_depths(df.limit(0), ["id"]).collect() == []
