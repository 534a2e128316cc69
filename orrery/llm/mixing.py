"""Mixing sources to target weights with balanced (cube-method) sampling.

Sources, by code point with null last, weigh 5, 2, 1 in turn and share 150 % of all words; a target stops at twice its
source's size, and the excess is shared again by weight. A document is taken floor(r) times and once more with
probability r - floor(r), where r is its source's target over its size. The cube method makes those draws balanced:
inclusion probabilities move along the null space of the constraints (word total, document total) until each document
but two is in or out. It runs in parallel over blocks of one source, then over what the blocks left, level by level, so
that only a landing problem of two documents a source remains, which is settled by the outcome nearest the totals.
Draws come from a seed, the block and a hash of the whole row, so reruns agree however rows are dealt out; which of rows
equal in all columns is taken makes no difference.

Nulls: a null text counts as empty (size 0, taken 0 words), null sources are one source of their own, null ids and
repeated rows are documents like others. An empty table gives an empty result. Other columns are ignored by
``plan_mix`` and kept by ``mix``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.common import WORD, documents, materialise, text_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 4096
SEED = 20240601
#: Source tables up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def _numbered(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0, by code point with null last: ranks inside range partitions plus the partitions' offsets."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = materialise(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    inside = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return inside.join(F.broadcast(offsets), "part").select("source", "source_size", "n_docs", (F.col("nth") - 1 + F.col("offset")).alias("rank"))


def source_targets(units: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from rows of (source, size)."""
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(_numbered(sources).withColumn("weight", weight), "mix-ranked")
    total = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    # the level only rises, and a source that is capped stays capped
    while True:
        capped = F.col("weight") * level > most * F.col("source_size")
        used, open_weight = ranked.agg(F.sum(F.when(capped, most * F.col("source_size")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        raised = (total - (used or 0.0)) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("weight") * level, most * F.col("source_size"))
    return ranked.withColumn("target", target.cast("double")).drop("weight")


def flight(sizes: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1 keeping both totals; at most two stay between."""
    p, size = p.tolist(), sizes.tolist()
    draws = rng.random(len(p) + 8).tolist()
    rest = [i for i in range(len(p) - 1, -1, -1) if 0 < p[i] < 1]
    held: list[int] = []
    while True:
        while len(held) < 3 and rest:
            held.append(rest.pop())
        if len(held) < 2:
            break
        if len(held) == 3:
            a, b, c = (size[i] for i in held)
            u = (b - c, c - a, a - b)
            if not any(u):
                u = (1, -1, 0)
        elif size[held[0]] == size[held[1]]:
            u = (1, -1)
        else:
            break
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(held, u) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(held, u) if d)
        step = up if draws.pop() * (up + down) < down else -down
        for i, d in zip(held, u):
            p[i] += step * d
            if p[i] < 1e-9:
                p[i] = 0.0
            elif p[i] > 1 - 1e-9:
                p[i] = 1.0
        held = [i for i in held if 0 < p[i] < 1]
        if not draws:
            draws = rng.random(len(p) + 8).tolist()
    return np.array(p)


def land(sizes: np.ndarray, p: np.ndarray, rounds: int = 16) -> np.ndarray:
    """Settle the last two at most: of all outcomes, that with the word total nearest, then the document total. Then
    exchange a document that is in for one that is out (or put one in, or out), as long as the word total comes nearer."""
    at = np.flatnonzero((p > 0) & (p < 1))
    want = float((sizes[at] * p[at]).sum())
    miss = lambda m: want - sum(sizes[i] for k, i in enumerate(at) if m >> k & 1)
    best = min(range(1 << len(at)), key=lambda m: (abs(miss(m)), abs(bin(m).count("1") - p[at].sum()), m))
    for k, i in enumerate(at):
        p[i] = best >> k & 1
    gap = miss(best)
    if not len(at):
        return p
    size = np.append(sizes, 0.0)  # the last stands for no document
    none = len(sizes)
    for _ in range(rounds):
        ins, outs = np.append(np.flatnonzero(p == 1), none), np.append(np.flatnonzero(p == 0), none)
        outs = outs[np.argsort(size[outs], kind="stable")]
        spots = np.searchsorted(size[outs], size[ins] + gap)
        left, i, o = min((abs(gap - (size[o] - size[i])), int(i), int(o)) for i, s in zip(ins, spots) for o in outs[max(0, s - 1) : s + 1])
        if left >= abs(gap) - 0.5:
            break
        gap -= size[o] - size[i]
        for k, v in ((i, 0.0), (o, 1.0)):
            if k != none:
                p[k] = v
    return p


def _fly(last: bool, level: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "row"], ignore_index=True)
        rng = np.random.default_rng([SEED, level, int(part["rank"].iloc[0]), int(part["block"].iloc[0])])
        sizes = part["size"].to_numpy(dtype=float)
        order = rng.permutation(len(part))
        p = np.empty(len(part))
        p[order] = flight(sizes[order], part["p"].to_numpy()[order], rng)
        part["p"] = land(sizes, p) if last else p
        return part

    return run


def plan_mix(units: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """Add source_size, target and copies to a written table of (row, key, size, source, ...): row is unique, key a hash
    that does not depend on how rows are dealt out."""
    targets = materialise(source_targets(units, weights, share, most), "mix-targets")
    small = targets.count() <= BROADCAST_SOURCES
    side = targets.withColumnRenamed("source", "__source")
    met = units.join(F.broadcast(side) if small else side, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-9)
    part = ratio - whole
    met = met.withColumn("copies", whole.cast("long")).withColumn("p", F.when(part > 1e-9, part).otherwise(0.0))
    columns = [*units.columns, "source_size", "target", "copies"]
    work = ["row", "key", "rank", "size", "p", "block"]
    schema = "row long, key long, rank long, size long, p double, block long"
    blocks = F.ceil(F.col("n_docs") / block)
    open_ = met.filter("p > 0").select("row", "key", "rank", "size", "p", F.pmod(F.xxhash64("key"), blocks).alias("block"))
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    taken, level = [], 0
    while True:
        last = largest <= block
        flown = open_.select(*work).groupBy("rank", "block").applyInPandas(_fly(last, level), schema)
        flown = materialise(flown, "mix-level")
        taken.append(flown.filter("p = 1").select("row"))
        if last:
            break
        # what is left: two a block at most
        largest, level = 2 * math.ceil(largest / block), level + 1
        n = math.ceil(largest / block)
        open_ = flown.filter("p > 0 AND p < 1").withColumn("block", F.pmod(F.xxhash64("block", "key"), F.lit(n)))
    extra = taken[0]
    for more in taken[1:]:
        extra = extra.unionByName(more)
    extra = materialise(extra.withColumnRenamed("row", "__taken"), "mix-taken")
    out = met.join(extra, F.col("row") == F.col("__taken"), "left")
    return out.withColumn("copies", F.col("copies") + F.when(F.col("__taken").isNotNull(), 1).otherwise(0)).select(*columns)


def sized(text_col: str = "text"):
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def units_of(docs: DataFrame, id_col: str, source_col: str, text_col: str, row) -> DataFrame:
    size = sized(text_col)
    hashed = [F.col(f"`{c}`") for c in sorted(docs.columns) if not c.startswith("__") and not re.search("map<|variant", docs.schema[c].dataType.simpleString())]
    return materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), row.alias("row"), size.alias("size"), F.xxhash64(*hashed).alias("key")), "mix-units")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents, each as often as the mix takes it (rows of no words by their probability, too)."""
    tagged = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-docs")
    counts = plan_mix(units_of(tagged, id_col, source_col, text_col, F.col("__row"))).filter("copies > 0").select(F.col("row").alias("__unit"), F.col("copies").cast("int").alias("__copies"))
    met = tagged.join(counts.hint("merge"), F.col("__row") == F.col("__unit"))
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark, sf_dir):
    units = units_of(documents(spark, sf_dir), "doc_id", "source", "text", F.monotonically_increasing_id())
    return plan_mix(units).select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {"op5_mixing": op5_mixing}
SQL: dict[str, str] = {}
