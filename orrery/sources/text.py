"""Readers for text formats, and sinks. Every reader goes through Spark's own readers, so any file system works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.scalars import to_double


def tsv_table(lines: DataFrame, value: str = "value") -> DataFrame:
    """The rows of an annotated TSV: comments start with '#', a row of dashes follows the header and the units two rows
    above. Rows of another width are dropped, cells are trimmed, empty ones null; all columns are strings.

    The place of the dashes is read from the file's head; the body is parsed in parallel.
    """
    body = lines.filter(~F.startswith(value, F.lit("#")) & (F.trim(value) != ""))
    head = body.limit(50).collect()  # the header block
    texts = [r[0] for r in head]
    dash = next((i for i, x in enumerate(texts) if x.strip() and set(x.replace("\t", "").strip()) == {"-"}), None)
    if dash is None or dash < 1:
        raise ValueError("no row of dashes under a header")
    names = [n.strip() for n in texts[max(0, dash - 2)].split("\t")]
    cells = F.split(F.col(value), "\t", -1)
    rows = body.filter(~F.col(value).isin(texts[: dash + 1])).select(cells.alias("c")).filter(F.size("c") == len(names))
    return rows.select(*[F.nullif(F.trim(F.get("c", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)])


def tsv_answer(lines: DataFrame, value: str = "value") -> DataFrame | None:
    """The table of a service's answer, or None where that is empty, an error stub ("Error=" in a line) or bare headers."""
    body = lines.filter(~F.startswith(value, F.lit("#")) & (F.trim(value) != ""))
    first = body.first()
    if first is None or first[value].startswith("Content-Type") or not lines.filter(F.contains(value, F.lit("Error="))).isEmpty():
        return None
    return tsv_table(lines, value)


def infer_numbers(df: DataFrame) -> DataFrame:
    """Make a string column numeric if every cell that isn't blank is a number: one aggregate pass for all columns."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    bad = df.agg(*[F.count(F.when((F.trim(F.col(c)) != "") & to_double(F.col(c)).isNull(), 1)).alias(c) for c in texts]).first() if texts else {}
    return df.withColumns({c: to_double(F.col(c)) for c in texts if bad[c] == 0})


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return infer_numbers(tsv_table(spark.read.text(path)))


def id_list(lines: DataFrame, value: str = "value", digits: tuple[int, int] = (5, 10)) -> DataFrame:
    """Distinct ids found in text, as longs."""
    found = F.explode(F.regexp_extract_all(F.col(value), F.lit(rf"\b(\d{{{digits[0]},{digits[1]}}})\b"), F.lit(1)).cast("array<bigint>"))
    return lines.select(found.alias("id")).distinct()


def optional(spark: SparkSession, path: str, schema: str, form: str = "csv") -> DataFrame:
    """A table, or an empty one of the schema where there is no such path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).format(form).load(path)


def required(spark: SparkSession, path: str, schema: str, form: str = "csv") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").format(form).load(path)


def newest(df: DataFrame, by: str, n: int = 30) -> DataFrame:
    """The newest records (a report: the limit is the feature)."""
    return df.orderBy(F.col(by).desc()).limit(n)


LOG = r"^\[?(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})\]?\s+(?:\[?(INFO|WARN|WARNING|ERROR)\]?\s+)?(.*)$"


def log_records(lines: DataFrame, value: str = "value", pattern: str = LOG) -> DataFrame:
    """(at, level, message) of the lines that carry a time."""
    part = lambda i: F.regexp_extract(value, pattern, i)
    rows = lines.filter(F.rlike(value, F.lit(pattern)))
    return rows.select(F.to_timestamp(F.replace(part(1), F.lit("T"), F.lit(" "))).alias("at"), F.coalesce(F.nullif(part(2), F.lit("")), F.lit("INFO")).alias("level"), part(3).alias("message"))


def activity(records: DataFrame, n: int = 14) -> DataFrame:
    """Per day: records and errors, of the last n days (a report)."""
    per = records.groupBy(F.to_date("at").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("level") == "ERROR", 1)).alias("errors"))
    return newest(per, "day", n)


def numbers_of(path_column: Column, names: list[str]) -> list[Column]:
    """Numeric fields of a JSON cell."""
    return [F.get_json_object(path_column, f"$.{n}").try_cast("double").alias(n) for n in names]


def append(df: DataFrame, path: str) -> None:
    """Append finished rows to a result table; Spark's commit protocol makes each batch whole or absent."""
    df.write.mode("append").parquet(path)


def resume(wanted: DataFrame, path: str, keys: list[str], schema: str) -> DataFrame:
    """What of wanted has no row in the result table yet."""
    done = optional(wanted.sparkSession, path, schema, "parquet")
    return wanted.join(done.select(*keys), keys, "left_anti")


def write_checked(df: DataFrame, path: str, unresolved: Column, most: float = 0.02) -> None:
    """Write only if at most a share of rows is unresolved: else nothing is written."""
    share = df.agg(F.coalesce(F.avg(unresolved.cast("int")), F.lit(0.0))).first()[0]
    if share > most:
        raise RuntimeError(f"{share:.1%} of rows are unresolved; nothing is written")
    df.write.mode("overwrite").parquet(path)
