"""Forms for keys and tables beyond one task give what the plain forms give."""

import numpy as np
import pytest

from orrery.operators import boxes, sampling


def test_box_search_of_large_keys_equals_the_grouped_one(spark):
    rng, rows = np.random.default_rng(5), []
    for k, n, p in ((1, 400, 2.3), (2, 60, 1.1), (3, 4, 1.0), (None, 300, 3.7)):
        t = np.sort(rng.uniform(0, 30, n))
        flux = 1 + rng.normal(0, 0.01, n) - 0.2 * (t % p < 0.2)
        rows += [(k, float(a), float(b), 0.01) for a, b in zip(t, flux)]
    rows += [(4, 5.0 + i / 1000, 1.0, 0.01) for i in range(200)]
    rows += [(1, 3.0, None, 0.01), (1, None, 1.0, 0.01), (2, float("nan"), 1.0, 0.01)]
    df = spark.createDataFrame(rows, "k long, t double, flux double, flux_err double").repartition(3)
    search = lambda m: boxes.box_least_squares(df, "k", n_periods=300, shortest=0.5, durations=(0.1, 0.2), max_points=m)
    plain, folded = search(10**6), search(100)
    assert plain.columns == folded.columns
    plain, folded = ({r.k: r for r in f.collect()} for f in (plain, folded))
    assert plain.keys() == folded.keys() == {1, 2, 3, 4, None}
    assert plain[1].n == 400 and plain[2].n == 60 and plain[3].period is None and plain[4].period is None
    assert abs(plain[1].period / 2.3 - 1) < 0.02 and abs(plain[None].period / 3.7 - 1) < 0.02
    for k, r in plain.items():
        assert [v if v is None else pytest.approx(v, rel=1e-6) for v in r] == list(folded[k])


@pytest.mark.parametrize("parts", [1, 3, 200])
def test_shards_follow_the_rank(spark, parts):
    keys = [None, *[f"k{i:03d}" for i in range(0, 300, 3)]]
    df = spark.createDataFrame([(k, 1) for k in reversed(keys)], "k string, __n int").repartition(4)
    assert [sorted((r.k for r in sampling.shard(df.select("k"), "k", i, 7, parts).collect()), key=str) for i in range(7)] == [sorted(keys[i::7], key=str) for i in range(7)]


def test_shard_of_nothing(spark):
    assert sampling.shard(spark.createDataFrame([], "k long, v string"), "k", 0, 3).collect() == []
