"""Statistics as expressions: robust scale, intervals, bins, tails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.scalars import col

MAD_SCALE = 1.4826
Z95 = 1.959963984540054


def median(x) -> Column:
    return F.percentile(col(x), 0.5)


def median_where(x, condition) -> Column:
    return F.percentile(F.when(col(condition), col(x)), 0.5)


def count_where(condition) -> Column:
    return F.count(F.when(col(condition), 1))


def robust(df: DataFrame, keys: list[str], x: str, where: Column | None = None) -> DataFrame:
    """Per key: med, mad (not scaled), sd (population) and n of x; two passes over one partitioning by key."""
    rows = df if where is None else df.filter(where)
    centre = rows.groupBy(*keys).agg(median(x).alias("med"), F.stddev_pop(x).alias("sd"), F.count(x).alias("n"))
    spread = rows.join(centre.select(*keys, "med"), keys).groupBy(*keys).agg(median(F.abs(F.col(x) - F.col("med"))).alias("mad"))
    return centre.join(spread, keys)


def wilson(k, n, z: float = Z95, empty: tuple[float | None, float | None] = (0.0, 1.0)) -> tuple[Column, Column]:
    """Bounds of a share; without any cases they are those of ``empty`` (0 and 1, both 0, or nulls)."""
    k, n = col(k).cast("double"), col(n).cast("double")
    p, zz = k / n, z * z
    centre, half = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    some = n > 0
    return F.when(some, F.greatest(centre - half, F.lit(0.0))).otherwise(F.lit(empty[0])), F.when(some, F.least(centre + half, F.lit(1.0))).otherwise(F.lit(empty[1]))


def rate(k, n) -> Column:
    """(k, n, rate, lo, hi); the rate is null without cases."""
    lo, hi = wilson(k, n)
    return F.struct(col(k).alias("k"), col(n).alias("n"), F.try_divide(col(k).cast("double"), col(n)).alias("rate"), lo.alias("lo"), hi.alias("hi"))


def binomial_tail(k, n, p) -> Column:
    """P(X >= k), by a fold over logarithms of factorials."""
    k, n, p = col(k), col(n), col(p)
    log_factorial = lambda m: F.aggregate(F.filter(F.sequence(F.lit(0), m), lambda i: i > 0), F.lit(0.0), lambda acc, i: acc + F.log(i.cast("double")))
    term = lambda i: F.exp(log_factorial(n) - log_factorial(i) - log_factorial(n - i) + i * F.log(p) + (n - i) * F.log(1 - p))
    return F.when(k <= 0, 1.0).when(k > n, 0.0).otherwise(F.aggregate(F.sequence(k, n), F.lit(0.0), lambda acc, i: acc + term(i)))


def bin_below(x, edges) -> Column:
    """Number of edges strictly below x: a value on an edge goes to the lower bin."""
    return F.size(F.filter(col(edges), lambda e: e < col(x)))


def bin_upto(x, edges) -> Column:
    """Number of edges not above x: a value on an edge goes to the upper bin."""
    return F.size(F.filter(col(edges), lambda e: e <= col(x)))


def edges_array(edges: list[float]) -> Column:
    return F.array(*[F.lit(float(e)) for e in edges])


def quantile_edges(df: DataFrame, x: str, bins: int) -> DataFrame:
    """One row: the inner cut points, linear between values."""
    return df.agg(F.percentile(F.col(x), [i / bins for i in range(1, bins)]).alias("edges"))


def line_sums(x, y, w) -> dict[str, Column]:
    """Weighted sums for a straight line."""
    x, y, w = col(x), col(y), col(w)
    return {"sw": F.sum(w), "sx": F.sum(w * x), "sy": F.sum(w * y), "sxx": F.sum(w * x * x), "sxy": F.sum(w * x * y)}


def line_fit(sw="sw", sx="sx", sy="sy", sxx="sxx", sxy="sxy") -> tuple[Column, Column, Column, Column]:
    """Intercept, slope and their standard errors from weighted sums; null when x has no spread."""
    sw, sx, sy, sxx, sxy = map(col, (sw, sx, sy, sxx, sxy))
    d = F.nullif(sw * sxx - sx * sx, F.lit(0.0))
    return (sxx * sy - sx * sxy) / d, (sw * sxy - sx * sy) / d, F.sqrt(sxx / d), F.sqrt(sw / d)


def draw(seed, *columns) -> Column:
    """A uniform number in [0, 1) fixed by a seed and the columns: the same on every engine that has MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)
