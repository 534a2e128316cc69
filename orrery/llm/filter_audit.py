"""How filters of a corpus interact: what each removes, repeats, alone catches and costs, in every order.

Five filters judge a whole text (words are runs of anything but ASCII white space):
A under 100 words; B 100 * distinct words < 80 * words; C 100 * letters A to Z > 10 * code points; D any of ``#$%&*|``;
E the same text stands in a row of a smaller id, in the whole table.

E comes from one sort: rows are dealt by range of (64-bit fingerprint of the text, id, place in the input) and sorted by
(fingerprint, text, id, place), and each row is compared with the one before. Copies of one text may run over many
tasks. So each task also gives out the runs of equal texts that hold its first or last fingerprint (two as a rule), and
those meet by full text: a run that began in an earlier task with a smaller id makes the rows at its head copies, too.
Texts of equal fingerprint are told apart, as only full texts are compared. Each row then is a mask of five bits; masks
are counted by part, and all orders are worked out from at most 32 counters a part.

Nulls: a null text counts as empty, a null part is the empty string; null ids come after all others and are not smaller
than each other. Repeated rows count as rows; copies of equal id are not E by each other. Labels that name an id more
than once count as marked if any of them is. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import beside, documents, materialise, space_cuts, text_of

FILTERS = "ABCDE"
TASK_CHARS = 32_000_000
CONTINUED = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(0x41, 0x5B))
MARKS = b"#$%&*|"


def mask_of(raw: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words, distinct = 0, set()
    for piece in space_cuts(raw):
        found = piece.split()
        words += len(found)
        distinct.update(found)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    failed = (words < 100, 100 * len(distinct) < 80 * words, 100 * capitals > 10 * len(raw.translate(None, CONTINUED)), len(raw) > len(raw.translate(None, MARKS)))
    return sum(1 << k for k, x in enumerate(failed) if x)


#: A row of the table (mask set), or a run of equal texts at an end of a task (text set).
SORTED = "task int, run long, id string, part string, mask int, open boolean, fingerprint long, text binary"
FIELDS = pa.schema([("task", pa.int32()), ("run", pa.int64()), ("id", pa.string()), ("part", pa.string()), ("mask", pa.int32()), ("open", pa.bool_()), ("fingerprint", pa.int64()), ("text", pa.binary())])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each with its mask, E included as far as this task knows."""
    task, run, mask = TaskContext.get().partitionId(), -1, 0
    first = last = text = None  # fingerprints of the task's first row and of the row before, text of the row before
    began: str | None = None  # id of the run's first row
    ends: list[tuple] = []  # runs of the last fingerprint so far
    heads: list[tuple] = []  # runs of the first fingerprint
    for batch in batches:
        rows = []
        for fingerprint, own, key, part in zip(*(batch[c].to_pylist() for c in ("fingerprint", "text", "id", "part"))):
            if run < 0 or fingerprint != last or own != text:
                run, began, mask = run + 1, key, mask_of(own)
                if run == 0:
                    first = fingerprint
                if fingerprint != last:
                    ends = []
                last, text = fingerprint, own
                ends.append((run, began, fingerprint, own))
                if fingerprint == first:
                    heads.append(ends[-1])
            later = key != began
            rows.append((task, run, key, part, mask | later << 4, fingerprint == first and not later, None, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FIELDS)], schema=FIELDS)
    if run >= 0:
        edges = [(task, number, key, None, None, None, fingerprint, own) for number, key, fingerprint, own in {x[0]: x for x in heads + ends}.values()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*edges), FIELDS)], schema=FIELDS)


def failure_masks(docs: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text", task_chars: int = TASK_CHARS, fingerprint=F.xxhash64) -> DataFrame:
    """(id, part, mask) of each row, in a written table: bit k of the mask is set if filter k of ABCDE fails."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(chars / task_chars))
    text = text_of(text_col)
    rows = docs.select(fingerprint(text).alias("fingerprint"), text.cast("binary").alias("text"), F.col(id_col).alias("key"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(part_col), F.lit("")).alias("part"))
    by_id = F.col("key").asc_nulls_last()
    dealt = rows.repartitionByRange(tasks, "fingerprint", by_id, "row").sortWithinPartitions("fingerprint", "text", by_id, "row")
    found = materialise(dealt.select("fingerprint", "text", F.col("key").cast("string").alias("id"), "part").mapInArrow(_compared, SORTED), "audit-sorted")
    runs = materialise(found.filter(F.col("mask").isNull()), "audit-runs")  # a few a task
    start = runs.groupBy("fingerprint", "text").agg(F.min(F.struct("task", "id")).alias("start"))
    repeated = runs.join(start, ["fingerprint", "text"]).filter((F.col("start.task") < F.col("task")) & ~F.col("start.id").eqNullSafe(F.col("id")))
    copies = materialise(repeated.select(F.col("task").alias("__task"), F.col("run").alias("__run")), "audit-copies")
    met = found.filter(F.col("mask").isNotNull()).join(beside(copies), F.col("open") & (F.col("task") == F.col("__task")) & (F.col("run") == F.col("__run")), "left")
    mask = F.when(F.col("__run").isNotNull(), F.col("mask").bitwiseOR(F.lit(16))).otherwise(F.col("mask"))
    return materialise(met.select(F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "part", mask.alias("mask")), "audit-masks")


def counters(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows a part, which add up over any split of the rows."""
    marked = labels.groupBy(F.col(id_col).alias("id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    all_ = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    some = masks.join(marked.filter("good + toxic > 0"), "id").groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    both = all_.unionByName(some.select("part", "mask", F.lit(0).cast("long").alias("n"), "good", "toxic"))
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def orders_report(counted: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step."""
    orders = F.array(*[F.lit("".join(x)) for x in itertools.permutations(FILTERS)])
    each = counted.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.array(*map(F.lit, range(1, len(FILTERS) + 1)))))
    # a filter's bit: its place in FILTERS
    bit = lambda k: F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, {k}, 1)) - 1)")
    before = sum((F.when(F.col("step") > k, bit(k)).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    each = each.withColumn("own", bit("step")).withColumn("before", before)
    gone, fails = F.col("mask").bitwiseAND(F.col("before")) != 0, F.col("mask").bitwiseAND(F.col("own")) != 0
    share = F.lit(math.factorial(len(FILTERS))) / F.bit_count("mask")  # orders in which a given filter of the mask is the first
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total("n", ~gone & ~fails).alias("kept"), total("n", ~gone & fails).alias("removed"), total("n", gone & fails).alias("redundant"), total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("good", ~gone & fails).alias("good_lost"), total("toxic", ~gone & fails).alias("toxic_lost"), F.sum(F.when(fails, F.col("n") * share.cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )


def op12_filter_audit(spark, sf_dir):
    masks = failure_masks(documents(spark, sf_dir))
    return orders_report(counters(masks, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op12_filter_audit": op12_filter_audit}
SQL = {
    "op12_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), b AS (
  SELECT doc_id, part, (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM b LEFT JOIN l ON b.doc_id = l.doc_id GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)
), o AS (
  SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits FROM f p, f q, f r, f s, f t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31
), e AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
)
SELECT part, filter_order, step,
  sum(CASE WHEN mask & before = 0 AND mask & own = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & own <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM c, e GROUP BY part, filter_order, step
"""
}
