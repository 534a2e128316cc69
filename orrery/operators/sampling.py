"""Samples that are fixed by a seed: strata, shards, balanced picks, block shuffles.

Draws are MD5 of seed and key, so any engine and any partitioning gives the same sample; ranks are taken inside strata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions.scalars import col
from orrery.functions.stats import bin_below, draw, quantile_edges


def strata(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Add ``stratum`` by quantile edges of x; a value on an edge goes to the lower stratum. The edges are one row."""
    return df.crossJoin(F.broadcast(quantile_edges(df, x, bins))).withColumn("stratum", bin_below(x, "edges")).drop("edges")


def stratified(df: DataFrame, key: str, x: str, bins: int, n: int, seed, exclude: DataFrame | None = None) -> DataFrame:
    """About n rows, evenly over quantile strata of x (the remainder goes to the first strata). Keys drawn before are
    left out after the strata are fixed."""
    drawn = strata(df.filter(F.col(x).isNotNull()), x, bins)
    if exclude is not None:
        drawn = drawn.join(exclude.select(key), key, "left_anti")
    quota = F.lit(n // bins) + F.when(F.col("stratum") < n % bins, 1).otherwise(0)
    w = Window.partitionBy("stratum").orderBy(draw(seed, key), key)
    return drawn.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= quota).drop("__n")


def shortfall(sample: DataFrame, bins: int, n: int) -> DataFrame:
    """(stratum, wanted, got) of the strata that were too small."""
    want = sample.sparkSession.range(bins).select(F.col("id").cast("int").alias("stratum"), (F.lit(n // bins) + F.when(F.col("id") < n % bins, 1).otherwise(0)).alias("wanted"))
    got = sample.groupBy("stratum").agg(F.count(F.lit(1)).alias("got"))
    return want.join(got, "stratum", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).filter("got < wanted")


def parse_shard(spec: str) -> tuple[int, int]:
    """'i/k' as numbers, 0 <= i < k."""
    i, k = map(int, spec.split("/"))
    if not 0 <= i < k:
        raise ValueError(f"not a shard: {spec}")
    return i, k


def shard(df: DataFrame, key: str, index: int, count: int, parts: int = 200) -> DataFrame:
    """Every count-th row by rank of the key: shards are disjoint, cover all and differ by one row at most. Ranks need a
    total order (null keys come first); use shard_by_hash where equal sizes aren't needed. Rows are ranked inside ranges of
    the key, and each range moves on by the rows before it. Ranges are cut at some ``parts`` keys of a sample of about 50
    times as many, which is all that reaches the driver; where the cuts fall changes no rank."""
    share = min(1.0, 50.0 * parts / max(df.count(), 1))
    seen = df.select(F.col(key).alias("c")).filter("c IS NOT NULL").sample(share, 1).distinct().orderBy("c").collect()
    cuts = [F.lit(r.c) for r in seen[:: max(1, len(seen) // parts)]]
    part = F.size(F.filter(F.array(*cuts), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    placed = df.withColumn("__part", part)
    sizes = placed.groupBy(F.col("__part").alias("__of")).agg(F.count(F.lit(1)).alias("__rows"))
    before = sizes.select("__of", (F.sum("__rows").over(Window.orderBy("__of")) - F.col("__rows")).alias("__before"))
    ranked = placed.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(key)))
    met = ranked.join(F.broadcast(before), F.col("__part") == F.col("__of"))
    return met.filter(F.pmod(F.col("__before") + F.col("__n") - 1, F.lit(count)) == index).select(*[F.col(f"`{c}`") for c in df.columns])


def shard_by_hash(df: DataFrame, key: str, index: int, count: int, seed=0) -> DataFrame:
    """Disjoint and covering, of about equal size, without a sort."""
    return df.filter(F.floor(draw(seed, key) * count) == index)


def balanced(df: DataFrame, key: str, truth: str, n_each: int, seed) -> DataFrame:
    """n_each rows of each class."""
    w = Window.partitionBy(truth).orderBy(draw(seed, key), key)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n_each).drop("__n")


def subsample(df: DataFrame, key: str, order: str, k: int, seed) -> DataFrame:
    """k points of each key."""
    w = Window.partitionBy(key).orderBy(draw(seed, key, order), order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= k).drop("__n")


def block_shuffle(df: DataFrame, key: str, t: str, x: str, block: int, seed) -> DataFrame:
    """Per key, cut the values into runs of ``block`` points and put the runs in a drawn order; times stay. Same values,
    same local noise, no period."""
    w = Window.partitionBy(key).orderBy(t)
    ranked = df.select(key, t, x, (F.row_number().over(w) - 1).alias("n")).withColumn("blk", F.floor(F.col("n") / block))
    moved = ranked.withColumn("d", draw(seed, key, "blk")).withColumn("m", F.row_number().over(Window.partitionBy(key).orderBy("d", "blk", "n")) - 1)
    return ranked.select(key, t, "n").join(moved.select(key, F.col("m").alias("n"), x), [key, "n"]).select(key, t, x)


def injections(hosts: DataFrame, key: str, per_host: int, seed, period=(0.5, 13.0), depth=(0.002, 0.5), duration=(0.02, 0.1)) -> DataFrame:
    """(key, k, period, depth, duration_fraction, t0_fraction): log-uniform periods and depths, per_host of each host."""
    k = F.explode(F.sequence(F.lit(0), F.lit(per_host - 1))).alias("k")
    rows = hosts.select(key, k)
    log_uniform = lambda name, lo, hi: lo * F.pow(F.lit(hi / lo), draw(f"{seed}-{name}", key, "k"))
    return rows.select(
        key, "k", log_uniform("period", *period).alias("period"), log_uniform("depth", *depth).alias("depth"),
        (duration[0] + (duration[1] - duration[0]) * draw(f"{seed}-duration", key, "k")).alias("duration_fraction"), draw(f"{seed}-t0", key, "k").alias("t0_fraction"),
    )


def pick_hosts(df: DataFrame, key: str, x: str, eligible, bins: int, n: int, seed) -> DataFrame:
    """A stratified pick among eligible hosts."""
    return stratified(df.filter(col(eligible)), key, x, bins, n, seed)
