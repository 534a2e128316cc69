"""Survey-level reports: funnels, stratified audits, recall, agreement, screening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions.scalars import col
from orrery.functions.stats import bin_below, bin_upto, count_where, edges_array, median, quantile_edges, wilson
from orrery.operators.relational import in_any, union_all
from orrery.tables import written


def funnel(**counts: tuple[DataFrame, Column | None]) -> DataFrame:
    """One row: for each name the rows of a table that satisfy a condition."""
    parts = [df.agg(F.count(F.lit(1) if when is None else F.when(when, 1)).alias(name)) for name, (df, when) in counts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)
    return out


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """after minus before, column by column, of two one-row reports."""
    b = before.select(*[F.col(c).alias(f"b_{c}") for c in before.columns])
    return after.crossJoin(b).select(*[(F.col(c) - F.col(f"b_{c}")).alias(c) for c in after.columns])


def stratified_audit(population: DataFrame, key: str, x: str, bins: int, sampled: DataFrame, **stages: DataFrame) -> DataFrame:
    """Per quantile stratum of the population: its share of the population, sampled keys, how many of those passed each
    stage and all before it, and the Wilson bounds of the last stage's rate."""
    edges = F.broadcast(quantile_edges(population.filter(F.col(x).isNotNull()), x, bins))  # one row
    weights = population.filter(F.col(x).isNotNull()).crossJoin(edges).groupBy(bin_below(x, "edges").alias("stratum")).agg(F.count(F.lit(1)).alias("population"))
    flagged = in_any(sampled.select(key).distinct().join(population.select(key, x).dropDuplicates([key]), key).filter(F.col(x).isNotNull()), [key], **stages).crossJoin(edges)
    nested, so_far = {}, F.lit(True)
    for name in stages:
        so_far = so_far & F.col(name)
        nested[name] = count_where(so_far).alias(name)
    got = flagged.groupBy(bin_below(x, "edges").alias("stratum")).agg(F.count(F.lit(1)).alias("sampled"), *nested.values())
    out = weights.join(got, "stratum", "left").na.fill(0)
    last = list(stages)[-1]
    lo, hi = wilson(last, "sampled")
    total = weights.agg(F.sum("population").alias("__total"))
    return out.crossJoin(F.broadcast(total)).select("stratum", "population", (F.col("population") / F.col("__total")).alias("weight"), "sampled", *stages, F.try_divide(F.col(last).cast("double"), "sampled").alias("rate"), lo.alias("lo"), hi.alias("hi"))


def weighted_rate(audit: DataFrame, k: str) -> DataFrame:
    """One row: the population rate, strata weighted by their share of the population."""
    return audit.agg(F.sum(F.col("weight") * F.try_divide(F.col(k).cast("double"), "sampled")).alias("weighted_rate"), F.try_divide(F.sum(k).cast("double"), F.sum("sampled")).alias("raw_rate"))


def posterior_rate(audit: DataFrame, k: str, draws: int = 20_000, seed: int = 11) -> DataFrame:
    """Percentiles 2.5, 50 and 97.5 of the weighted rate under Jeffreys priors: draws on a table of a row a stratum."""
    import numpy as np

    rows = audit.select("weight", k, "sampled").orderBy("stratum").collect()  # a row a stratum
    rng = np.random.default_rng(seed)
    total = sum(r[0] * rng.beta(r[1] + 0.5, r[2] - r[1] + 0.5, draws) for r in rows) if rows else np.zeros(1)
    low, mid, high = np.percentile(total, [2.5, 50, 97.5])
    return audit.sparkSession.createDataFrame([(float(low), float(mid), float(high))], "lo double, mid double, hi double")


def histogram(df: DataFrame, x: str, edges: list[float], upper: bool = True) -> DataFrame:
    """(bin, lo, hi, n, share) over fixed edges, empty bins included: [a, b) if upper, else (a, b]."""
    at = (bin_upto if upper else bin_below)(x, edges_array(edges))
    counts = df.filter(F.col(x).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]), 1)], "bin int, lo double, hi double")
    total = df.agg(F.count(x).alias("__t"))
    return bins.join(counts, "bin", "left").crossJoin(F.broadcast(total)).select("bin", "lo", "hi", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), "__t").alias("share"))


def recall_by(df: DataFrame, by: dict[str, Column], hit: Column) -> DataFrame:
    """(dimension, value, n, k, rate, lo, hi) of a condition over several dimensions and overall."""
    dims = [F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value"))] + [F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("value")) for d, c in by.items()]
    long = df.select(hit.alias("__hit"), F.explode(F.array(*dims)).alias("d")).groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n"), count_where("__hit").alias("k"))
    lo, hi = wilson("k", "n")
    return long.select("dimension", "value", "n", "k", (F.col("k") / F.col("n")).alias("rate"), lo.alias("lo"), hi.alias("hi"))


def gate_counts(df: DataFrame, gates: list[str]) -> DataFrame:
    """(gate, n): how many rows fail each gate, from one pass."""
    one = df.agg(*[count_where(F.coalesce(g, F.lit(False))).alias(g) for g in gates])
    return one.select(F.explode(F.array(*[F.struct(F.lit(g).alias("gate"), F.col(g).alias("n")) for g in gates])).alias("x")).select("x.*")


def agreement(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """One row: keys in both, only in one, and with another value."""
    both = a.select(key, F.col(value).alias("va"), F.lit(1).alias("ia")).join(b.select(key, F.col(value).alias("vb"), F.lit(1).alias("ib")), key, "full")
    two = F.col("ia").isNotNull() & F.col("ib").isNotNull()
    return both.agg(count_where(two).alias("both"), count_where(F.col("ib").isNull()).alias("only_left"), count_where(F.col("ia").isNull()).alias("only_right"), count_where(two & ~F.col("va").eqNullSafe(F.col("vb"))).alias("differ"))


def confusion(df: DataFrame, truth: Column, found: Column) -> DataFrame:
    return df.groupBy(truth.alias("truth"), found.alias("found")).agg(F.count(F.lit(1)).alias("n"))


def coverage_of_intervals(df: DataFrame, quantities: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """(quantity, n, within1, within2, inflation): shares of (estimate, error, truth) within one and two errors, and the
    68th percentile of the absolute pull, by which the errors would have to grow."""
    pulls = [F.struct(F.lit(q).alias("quantity"), (F.abs(e - t) / F.nullif(s, F.lit(0.0))).alias("pull")) for q, (e, s, t) in quantities.items()]
    long = df.select(F.explode(F.array(*pulls)).alias("x")).select("x.*").filter("pull IS NOT NULL")
    counts = written(long.groupBy("quantity", "pull").agg(F.count(F.lit(1)).alias("n")), "pulls")
    share = lambda most: F.sum(F.when(F.col("pull") <= most, F.col("n")).otherwise(0)) / F.sum("n")
    per = counts.groupBy("quantity").agg(F.sum("n").alias("n"), share(1).alias("within1"), share(2).alias("within2"))
    return per.join(counted_quantile(counts, "quantity", "pull", "n", 0.6827).withColumnRenamed("value", "inflation"), "quantity")


def counted_quantile(counts: DataFrame, by: str, x: str, n: str, share: float, parts: int = 200) -> DataFrame:
    """(by, value): the exact quantile of values with counts, linear between neighbours, without a group in one task. Values
    are cut into ranges; only those ranges that hold the wanted ranks are sorted. Where the cuts fall changes no value."""
    cuts = counts.groupBy(F.col(by).alias("__by")).agg(F.percentile_approx(x, [i / parts for i in range(1, parts)], 1000).alias("__cuts"))
    placed = counts.join(F.broadcast(cuts), F.col(by) == F.col("__by")).select(by, x, n, bin_upto(x, "__cuts").alias("__part"))
    sizes = placed.groupBy(by, "__part").agg(F.sum(n).alias("__rows"))
    before = sizes.select(by, "__part", "__rows", (F.sum("__rows").over(Window.partitionBy(by).orderBy("__part")) - F.col("__rows")).alias("__before"), F.sum("__rows").over(Window.partitionBy(by)).alias("__all"))
    at = share * (F.col("__all") - 1)
    low, high = F.floor(at), F.ceil(at)
    held = lambda k, start, size: (k >= start) & (k < start + size)
    wanted = before.filter(held(low, F.col("__before"), F.col("__rows")) | held(high, F.col("__before"), F.col("__rows")))
    near = placed.join(F.broadcast(wanted), [by, "__part"])
    start = F.col("__before") + F.sum(n).over(Window.partitionBy(by, "__part").orderBy(x)) - F.col(n)
    found = near.withColumn("__start", start).groupBy(by).agg(
        F.max(F.when(held(low, F.col("__start"), F.col(n)), F.col(x))).alias("__low"), F.max(F.when(held(high, F.col("__start"), F.col(n)), F.col(x))).alias("__high"), F.first(at - low).alias("__share")
    )
    return found.select(by, (F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__share")).alias("value"))


def contrast(df: DataFrame, short: Column, hit: Column) -> DataFrame:
    """One row: rates of a condition in two groups, and the chance of none among the first at the second's rate, with its
    logarithm, as the chance itself underflows for large groups."""
    m = df.agg(count_where(short).alias("n1"), count_where(short & hit).alias("k1"), count_where(~short).alias("n2"), count_where(~short & hit).alias("k2"))
    return m.select("*", F.try_divide("k1", "n1").alias("rate1"), F.try_divide("k2", "n2").alias("rate2"), F.pow(1 - F.try_divide("k2", "n2"), "n1").alias("p_none"), (F.col("n1") * F.log(1 - F.try_divide("k2", "n2"))).alias("ln_p_none"))


def counts_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row of conditional counts."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[count_where(c).alias(k) for k, c in conditions.items()])


def sky_assessment(edges: DataFrame, key: str, floors=(3.0, 6.0, 10.0)) -> DataFrame:
    """(key, floor): bright-enough and viable neighbours, those that can't be separated, the closest viable one; edges
    have required_depth, sep_arcsec, offset, tolerance (without floor) and neighbour."""
    rows = edges.withColumn("floor", F.explode(F.array(*[F.lit(f) for f in floors])))
    tol = F.greatest("tolerance", "floor")
    bright = F.col("required_depth") <= 1
    viable = bright & (F.abs(F.col("sep_arcsec") - F.col("offset")) <= tol)
    return rows.groupBy(key, "floor").agg(
        count_where(bright).alias("bright"), count_where(viable).alias("viable"), count_where(viable & (F.col("sep_arcsec") <= tol)).alias("unseparable"),
        F.min_by(F.when(viable, F.col("neighbour")), F.when(viable, F.struct("sep_arcsec", "neighbour"))).alias("closest"),
    )


def screening(scored: DataFrame, score: str, label: str, recalls=(0.95, 0.9, 0.8), steps: int = 96) -> DataFrame:
    """Per wanted recall: the highest threshold of a grid that still meets it, and the share of rows it would skip."""
    # rows are counted once by the thresholds that they reach; per threshold a sum over so many counts is left
    grid = F.array(*[F.lit(round((i + 1) / (steps + 4), 6)) for i in range(steps)])
    near = F.greatest(F.least(F.floor(F.col(score) * (steps + 4)), F.lit(steps)), F.lit(0)).cast("int")
    reached = near + F.when(F.get(grid, near) <= F.col(score), 1).when((near > 0) & (F.get(grid, near - 1) > F.col(score)), -1).otherwise(0)
    counts = scored.groupBy(reached.alias("reached")).agg(F.count(F.lit(1)).alias("n"), count_where(F.col(label) == 1).alias("hits"))
    held = counts.agg(F.collect_list(F.struct("reached", "n", "hits")).alias("h"), F.sum("hits").alias("all_hits"), F.sum(F.when(F.col("reached").isNotNull(), F.col("n"))).alias("all"))
    per = held.select("*", F.posexplode(grid).alias("i", "threshold"))
    above = lambda c: F.aggregate(F.filter("h", lambda x: x["reached"] > F.col("i")), F.lit(0).cast("long"), lambda acc, x: acc + x[c])
    per = per.select("threshold", F.try_divide(above("hits"), "all_hits").alias("recall"), F.try_divide(F.col("all") - above("n"), "all").alias("skipped"))
    return union_all([per.filter(F.col("recall") >= r).groupBy().agg(F.max("threshold").alias("threshold"), F.max_by("recall", "threshold").alias("recall"), F.max_by("skipped", "threshold").alias("skipped")).withColumn("wanted", F.lit(r)) for r in recalls])


def cross_validated(df: DataFrame, key: str, label: str, numbers: list[str], categories: list[str], folds: int = 5, seed: int = 7) -> DataFrame:
    """(model, fold, auc) of a logistic regression and boosted trees, folds by hash inside each class. Every pass of a fit
    reads a written table, in which rows of a fold that are equal in label and features are one row with their number as
    its weight; both models of a fold share its indexes and scales. Missing numbers become the median of the others."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    from orrery.functions.stats import draw

    rows = df.select(F.floor(draw(seed, key) * folds).cast("int").alias("__fold"), F.col(label).cast("double").alias("label"), *[F.nanvl(F.col(n).cast("double"), F.lit(None)).alias(n) for n in numbers], *categories)
    rows = written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("__times")), "folds")
    total = rows.agg((F.sum(F.col("label") * F.col("__times")) / F.sum(F.when(F.col("label").isNotNull(), F.col("__times")))).alias("share"), *[count_where(F.col(n).isNull()).alias(f"__{n}") for n in numbers]).first()
    share = total["share"] or 0.5
    rows = rows.withColumn("weight", F.col("__times") * F.when(F.col("label") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9)))
    steps = [StringIndexer(inputCol=c, outputCol=f"{c}__n", handleInvalid="keep") for c in categories] + [OneHotEncoder(inputCols=[f"{c}__n" for c in categories], outputCols=[f"{c}__v" for c in categories])] * bool(categories)
    steps += [VectorAssembler(inputCols=[*numbers, *[f"{c}__v" for c in categories]], outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True)]
    models = {"logistic": LogisticRegression(weightCol="weight", maxIter=30), "boosted": GBTClassifier(weightCol="__times", maxIter=10, maxDepth=3, seed=seed)}
    out = []
    for f in range(folds):
        train, fill = rows.filter(F.col("__fold") != f), {}
        for n in numbers:
            if total[f"__{n}"]:
                counts = train.filter(F.col(n).isNotNull()).groupBy(F.lit(0).alias("__one"), n).agg(F.sum("__times").cast("long").alias("n"))
                fill[n] = counted_quantile(counts, "__one", n, "n", 0.5).first()["value"]
        own = rows.fillna(fill) if fill else rows
        ready = Pipeline(stages=steps).fit(own.filter(F.col("__fold") != f)).transform(own).select("__fold", "__times", "label", "weight", "features")
        for name, m in models.items():
            found = m.fit(ready.filter(F.col("__fold") != f)).transform(ready.filter(F.col("__fold") == f))
            out.append((name, f, float(BinaryClassificationEvaluator(weightCol="__times").evaluate(found))))
    return df.sparkSession.createDataFrame(out, "model string, fold int, auc double")


def bisected(df: DataFrame, x: str, thresholds: list[float]) -> DataFrame:
    """(threshold, n) of rows at or above each threshold."""
    counts = df.agg(*[count_where(col(x) >= float(t)).alias(f"n{i}") for i, t in enumerate(thresholds)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n{i}").alias("n")) for i, t in enumerate(thresholds)])).alias("g")).select("g.*")


def median_by(df: DataFrame, by: list[str], *xs: str) -> DataFrame:
    return df.groupBy(*by).agg(*[median(x).alias(x) for x in xs])
