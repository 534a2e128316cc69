"""The small assessment operators that no query shows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from orrery.operators import assessment as A
from orrery.operators import relational as rel


def test_orders_and_tags(spark):
    rows = spark.createDataFrame([("a", 1), ("z", 2), ("b", 3), (None, 4), ("b", 5)], "v string, n int")
    assert [r.n for r in A.ranked_by(rows, "v", ["b", "a"], F.desc("n")).collect()] == [5, 3, 1, 4, 2]
    assert A.variant_tag({"min": 3, "grid": None, "snr": 2.5}) == "min3_snr2.5" and A.variant_tag({}) == ""


def test_epoch_scales(spark):
    for first, offset, mjd in ((2000.0, 2455197.5, 2000.0 + 2455197.5 - 2400000.5), (59000.0, 0.0, 59000.0), (2459000.0, 0.0, 59000.0 - 0.5)):
        rows = spark.createDataFrame([(str(first), 1.0, 0.1, "false"), ("nan", 1.0, 0.1, None), (str(first), 1.0, 0.1, "TRUE"), (str(first), 1.0, 0.0, "0")], "t string, f double, e double, bad string")
        assert [r.t_mjd for r in A.epoch_arrays(rows, "t", "f", "e", ["bad"], offset).collect()] == [mjd]
    assert A.epoch_arrays(spark.createDataFrame([("7", 1.0, 0.1, "0")], "t string, f double, e double, bad string"), "t", "f", "e", ["bad"], 0.0).count() == 0


def test_scales_of_each_key(spark):
    rows = [("a", 2000.0 + i) for i in range(5)] + [("b", 59000.0), ("b", 59001.0), ("b", 3.0)] + [("c", 2459000.5), (None, 51000.0), ("d", 9.0)]
    df = spark.createDataFrame([(k, str(t), 1.0, 0.1) for k, t in rows], "k string, t string, f double, e double").repartition(3)
    got = A.epoch_arrays(df, "t", "f", "e", [], 2455197.5, "k")
    assert sorted((str(r.k), r.t_mjd) for r in got.collect()) == sorted([("a", 57197.0 + i) for i in range(5)] + [("b", 59000.0), ("b", 59001.0), ("b", 3.0), ("c", 59000.0), ("None", 51000.0)])
    with pytest.raises(Exception, match="no known scale"):
        A.epoch_arrays(df, "t", "f", "e", [], 2455197.5, "k", "error").collect()


def test_long_manifests_are_refused(spark):
    lines = spark.createDataFrame([(f"part{i}", "00") for i in range(5)], "name string, digest string")
    assert rel.bundle_digest(lines, "name", "digest", 5).first()[0] == hashlib.sha256("".join(f"part{i}\t00\n" for i in range(5)).encode()).hexdigest()
    with pytest.raises(Exception, match="manifest of over 4 lines"):
        rel.bundle_digest(lines, "name", "digest", 4).collect()
