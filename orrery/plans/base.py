"""Registration of queries, and the driver's tables in the roles of the operators.

A query is registered under its function's name with the SQL it must match. Doubles are rounded on both sides, as sums
over partitions differ in their last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import scalars as S
from orrery.operators import series

DIGITS = 6


class Registry:
    def __init__(self) -> None:
        self.QUERIES: dict[str, Callable] = {}
        self.SQL: dict[str, str] = {}

    def add(self, sql: str | None = None, rounded: tuple = (), digits: int = DIGITS):
        def wrap(f):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                df = f(Tables(spark, sf_dir))
                return df.withColumns({c: F.round(F.col(c), digits) + 0.0 for c in rounded}) if rounded else df

            run.__doc__ = f.__doc__
            self.QUERIES[f.__name__] = run
            if sql:
                fixed = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in rounded)
                self.SQL[f.__name__] = f"SELECT * REPLACE ({fixed}) FROM ({sql})" if rounded else sql
            return f

        return wrap


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def series(self) -> DataFrame:
        """events as series: key k, time t in days, flux over the key's median, band, and an ephemeris of the key."""
        e = self.events.select(F.col("user_id").alias("k"), S.days("ts").alias("t"), F.col("value").alias("v"), F.col("event_type").alias("band"), "event_id")
        return series.normalised(e, ["k"], "v").withColumns({"flux_err": F.lit(0.05), **ephemeris()})

    @property
    def curves(self) -> DataFrame:
        """events of 40 groups of users as light curves g: scatter of a hundredth, with events planted in two groups of
        three (period 1.9 days and more), and in every fifth group the raw series, which is no light curve."""
        g = F.col("k") % 40
        rows = self.series.select(g.alias("g"), "t", "flux", "event_id")
        depth = F.when(F.col("g") % 3 == 0, 0.0).otherwise(0.08 + 0.01 * (F.col("g") % 7))
        model = S.trapezoid("t", 1.9 + 0.17 * (F.col("g") % 11), F.lit(19720.4), F.lit(0.45), F.lit(0.3), depth, depth * 0.3)
        quiet = (1 + 0.01 * (F.col("flux") - 1)) * (1 - model)
        return rows.withColumns({"flux": F.when(F.col("g") % 5 == 0, F.col("flux")).otherwise(quiet), "flux_err": F.lit(0.01)})

    @property
    def lights(self) -> DataFrame:
        """events by type as light curves of 3 days' period, their events (0.2 deep, 0.6 days long) a tenth of a day off the
        nominal t0; ``part`` is the week, ``stretch`` three days."""
        e = self.series.select("band", "t", ((1 + 0.01 * (F.col("flux") - 1)) * (1 - S.trapezoid("t", F.lit(3.0), F.lit(19720.5 + 0.1), F.lit(0.6), F.lit(0.5), F.lit(0.2), F.lit(0.1)))).alias("flux"), "event_id")
        week, stretch = F.floor((F.col("t") - 19723) / 7), F.floor((F.col("t") - 19723) / 3)
        return e.withColumns({"flux_err": F.lit(0.01), "period": F.lit(3.0), "t0": F.lit(19720.5), "duration": F.lit(0.6), "part": week, "stretch": stretch})


def ephemeris() -> dict:
    return {"period": F.lit(1.7) + (F.col("k") % 7) * F.lit(0.31), "t0": F.lit(19720.25), "duration": F.lit(0.4)}


def mod(x: str, p: str) -> str:
    return f"(({x}) - ({p}) * floor(({x}) / ({p})))"


def phase(t: str = "t", p: str = "period", t0: str = "t0") -> str:
    return f"({mod(f'{t} - {t0} + {p} / 2', p)} / {p} - 0.5)"


def epoch(t: str = "t", p: str = "period", t0: str = "t0") -> str:
    return f"round_even(({t} - {t0}) / {p}, 0)::BIGINT"


def inside(widths: float = 1.0) -> str:
    return f"(abs({phase()}) < duration / period / 2 * {widths})"


def trapezoid(t: str, p: str, t0: str, duration: str, ingress: str, depth: str, depth2: str) -> str:
    def dip(centre: str, d: str) -> str:
        x = f"abs({mod(f'{t} - ({centre}) + {p} / 2', p)} - {p} / 2)"
        return f"{d} * least(greatest(({duration} / 2 - {x}) / ({ingress} * {duration} / 2), 0.0), 1.0)"

    return f"({dip(t0, depth)} + {dip(f'{t0} + {p} / 2', depth2)})"


#: The same series in SQL.
SERIES = """ev AS (
  SELECT user_id AS k, epoch_us(ts)::DOUBLE / 86400000000.0 AS t, value AS v, event_type AS band, event_id FROM events
), s AS (
  SELECT *, v / quantile_cont(v, 0.5) OVER (PARTITION BY k) AS flux, 0.05::DOUBLE AS flux_err, 1.7::DOUBLE + (k % 7) * 0.31::DOUBLE AS period, 19720.25::DOUBLE AS t0, 0.4::DOUBLE AS duration FROM ev
)"""

#: ``lights`` in SQL, after SERIES.
LIGHTS = f"""l AS (
  SELECT band, t, (1 + 0.01 * (flux - 1)) * (1 - {trapezoid("t", "3.0::DOUBLE", "19720.6::DOUBLE", "0.6::DOUBLE", "0.5::DOUBLE", "0.2::DOUBLE", "0.1::DOUBLE")}) AS flux, event_id, 3.0::DOUBLE AS period, 19720.5::DOUBLE AS t0, 0.6::DOUBLE AS duration,
    floor((t - 19723) / 7)::BIGINT AS part FROM s
)"""
