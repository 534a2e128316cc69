"""Key-based table work: unions, upserts, resumption, comparisons, crosstabs, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions.scalars import col, same_value


def pick_column(df: DataFrame, aliases: list[str], required: bool = True) -> str | None:
    """The first alias that names a column, whatever its case."""
    by_lower = {c.lower(): c for c in df.columns}
    found = next((by_lower[a.lower()] for a in aliases if a.lower() in by_lower), None)
    if found is None and required:
        raise KeyError(f"none of {aliases} in {df.columns}")
    return found


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_key(base: DataFrame, others: list[DataFrame], keys: list[str] | None) -> DataFrame:
    """base's rows, and from the others, in their order, those whose key is new. Idempotent. Without keys: distinct rows."""
    if not keys:
        return union_all([base, *others]).distinct()
    out = base
    for nth, other in enumerate(others):
        ranked = other.join(out.select(*keys), keys, "left_anti")
        out = out.unionByName(first_per_key(ranked, keys, [*[F.col(c) for c in ranked.columns if c not in keys]]), allowMissingColumns=True)
    return out


def first_per_key(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first n rows of each key; without an order, by all columns in turn."""
    order = order or [c for c in df.columns if c not in keys] or keys
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def last_wins(df: DataFrame, keys: list[str], sequence) -> DataFrame:
    """Per key the row of the greatest sequence number, by partial maxima."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), col(sequence)).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def upsert(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Later parts replace rows of the same key."""
    ranked = union_all([p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)])
    return last_wins(ranked, keys, "__part").drop("__part")


def todo(wanted: DataFrame, done: DataFrame, keys: list[str], done_when: Column | None = None) -> DataFrame:
    """Rows still to be worked on: those without a finished result."""
    finished = done if done_when is None else done.filter(done_when)
    return wanted.join(finished.select(*keys), keys, "left_anti")


def lookup(df: DataFrame, side: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Left join to one row per key of side (of several, the least by the named columns in turn), taking only the named
    columns, so that no other name can collide."""
    one = side.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("__one")).select(*keys, *[F.col(f"__one.{c}").alias(c) for c in columns])
    return df.join(one, keys, "left")


def fill_absent(expected: DataFrame, found: DataFrame, keys: list[str], column: str, default: str) -> DataFrame:
    """Every expected key with its value, or the default where nothing was found: never silently missing."""
    return expected.join(found.select(*keys, column), keys, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def append_missing(df: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    return df.unionByName(more.join(df.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def in_any(df: DataFrame, keys: list[str], **members: DataFrame) -> DataFrame:
    """A boolean column a member table: whether the key is in it."""
    for name, m in members.items():
        flag = m.select(*keys).distinct().withColumn(name, F.lit(True))
        df = df.join(flag, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by a and b with margins: 'ALL' stands for a total. Nulls stay nulls."""
    cube = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("ga"), F.grouping(b).alias("gb"))
    return cube.select(F.when(F.col("ga") == 1, "ALL").otherwise(F.col(a).cast("string")).alias(a), F.when(F.col("gb") == 1, "ALL").otherwise(F.col(b).cast("string")).alias(b), "n")


def value_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def grouping_counts(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Counts over several sets of columns at once, with the set's name."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    expanded = df.select(F.explode(F.array(*[F.struct(F.lit("|".join(s)).alias("grouping"), *[(F.col(c).cast("string") if c in s else F.lit(None).cast("string")).alias(c) for c in every]) for s in sets])).alias("g"))
    return expanded.groupBy("g.grouping", *[f"g.{c}" for c in every]).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, x: str) -> DataFrame:
    """count, mean, std (sample), min, exact quartiles, max."""
    q = F.percentile(x, [0.25, 0.5, 0.75])
    return df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(x).alias("max"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")).withColumn("n_surplus", F.col("n_rows") - F.col("n_keys"))


def differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], examples: int | None = None) -> DataFrame:
    """(keys, column, left, right) wherever two tables differ, numbers within a tolerance; a key on one side only
    differs in '__row'. examples keeps so many rows of each column, while counts come from this table without it."""
    left = a.select(*keys, F.struct(*columns).alias("__a"))
    both = left.join(b.select(*keys, F.struct(*columns).alias("__b")), keys, "full")
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    rows = [F.when(F.col("__a").isNull() | F.col("__b").isNull(), F.struct(F.lit("__row").alias("column"), F.when(F.col("__a").isNull(), "absent").otherwise("present").alias("left"), F.when(F.col("__b").isNull(), "absent").otherwise("present").alias("right")))]
    both_there = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    rows += [F.when(both_there & ~same_value(text("__a", c), text("__b", c)), F.struct(F.lit(c).alias("column"), text("__a", c).alias("left"), text("__b", c).alias("right"))) for c in columns]
    out = both.select(*keys, F.explode(F.array_compact(F.array(*rows))).alias("d")).select(*keys, "d.*")
    return out if examples is None else first_per_key(out, ["column"], [F.col(k) for k in keys], examples)


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's values as text."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


#: Lines of a manifest: a digest over their text is made in one task.
MOST_LINES = 1_000_000


def bundle_digest(df: DataFrame, name: str, digest: str, most: int = MOST_LINES) -> DataFrame:
    """One digest over sorted 'name<tab>digest' lines of a manifest, a row a part. A digest of one text can't be made in
    pieces, so a table of more than ``most`` lines is refused before it is gathered: digest it by parts first."""
    lines = df.select(F.concat_ws("\t", name, digest).alias("line")).limit(most + 1)
    held = lines.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("line")).alias("lines"))
    refused = F.raise_error(F.lit(f"a manifest of over {most} lines")).cast("string")
    return held.select(F.when(F.col("n") > most, refused).otherwise(F.sha2(F.concat(F.array_join("lines", "\n"), F.lit("\n")), 256)).alias("bundle_sha256"))


def verify_bundle(frozen: DataFrame, now: DataFrame, name: str, digest: str) -> DataFrame:
    """(name, status): same, changed, missing or extra."""
    a, b = frozen.select(name, F.col(digest).alias("was")), now.select(name, F.col(digest).alias("is"))
    status = F.when(F.col("is").isNull(), "missing").when(F.col("was").isNull(), "extra").when(F.col("was") == F.col("is"), "same").otherwise("changed")
    return a.join(b, name, "full").select(name, status.alias("status"))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order (a report: the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def best_per_category(df: DataFrame, name: str, metrics: dict[str, Column], tie: str) -> DataFrame:
    """For each metric the row of its greatest value (least tie column among equals)."""
    long = df.select(name, tie, F.explode(F.array(*[F.struct(F.lit(m).alias("category"), v.cast("double").alias("value")) for m, v in metrics.items()])).alias("m")).select(name, tie, "m.*").filter("value IS NOT NULL")
    best = F.max_by(F.struct(name, "value"), F.struct(F.col("value"), -F.col(tie)))
    return long.groupBy("category").agg(best.alias("b")).select("category", "b.*")


def checklist(*checks: tuple[str, DataFrame]) -> DataFrame:
    """(name, ok, detail) of checks that are one-row frames with columns ok and detail."""
    return union_all([f.select(F.lit(n).alias("name"), "ok", F.col("detail").cast("string").alias("detail")) for n, f in checks])


def flat(df: DataFrame, keep: list[str], *arrays: str) -> DataFrame:
    """Nested arrays of structs to rows: each name is exploded in turn and its fields are taken up."""
    for name in arrays:
        df = df.select(*keep, F.explode(name).alias("__x"))
        fields = df.schema["__x"].dataType.names
        df = df.select(*keep, *[F.col(f"__x.{f}").alias(f) for f in fields])
        keep = [*keep, *[f for f in fields if f not in arrays]]
    return df
