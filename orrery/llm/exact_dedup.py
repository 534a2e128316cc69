"""Exact dedup with a two-pass Bloom filter.

Pass one hashes every normalised text (SHA-256) and builds, from the hashes alone, the bitmap of filter positions that
were set at least twice. Pass two probes it: a row whose probes are not all set twice is certainly unique and passes
straight through; only the other rows are shuffled, grouped by their full digest and given a survivor.

The filter has 16 bits a row up to ``max_bits`` (32 MiB), which bounds what is broadcast. Beyond that the share of
false alarms grows, so more rows shuffle (16-byte rows of digest and id, at worst all of them); results never change.

Nulls: a null text counts as empty. Null ids sort after all others; a group of null ids alone has a null keep_id.
Repeated rows (same id and text): exactly one of them is kept. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import SPACE, documents, materialise, text_of

SEGMENT = 1 << 16
MAX_BITS = 1 << 28
EMIT_ROWS = 1 << 18


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def _probes(digests: pd.Series, bits: int) -> np.ndarray:
    """Four filter positions a digest, one from each 64-bit quarter."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)
    return (words & np.uint64(bits - 1)).astype(np.int64)


def _partial_filters(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0

        def emit() -> pd.DataFrame:
            at, n = np.unique(np.concatenate(held).ravel(), return_counts=True)
            cuts = np.flatnonzero(np.diff(at // SEGMENT)) + 1
            out = []
            for p, c in zip(np.split(at, cuts), np.split(n, cuts)):
                low = (p % SEGMENT).astype("<u2")
                out.append((int(p[0] // SEGMENT), low[c == 1].tobytes(), low[c > 1].tobytes()))
            return pd.DataFrame(out, columns=["segment", "once", "twice"])

        for batch in batches:
            if len(batch):
                held.append(_probes(batch["digest"], bits))
                rows += len(batch)
            if rows >= EMIT_ROWS:
                yield emit()
                held, rows = [], 0
        if rows:
            yield emit()

    return run


def _merge_segment(part: pd.DataFrame) -> pd.DataFrame:
    """Positions set twice in one segment, as a packed bitmap; none if there are none."""
    once = np.zeros(SEGMENT, dtype=np.int64)
    for x in part["once"]:
        once[np.frombuffer(x, dtype="<u2")] += 1
    for x in part["twice"]:
        once[np.frombuffer(x, dtype="<u2")] += 2
    hit = once > 1
    rows = [(part["segment"].iloc[0], np.packbits(hit, bitorder="little").tobytes())] if hit.any() else []
    return pd.DataFrame(rows, columns=["segment", "bitmap"])


def repeated_flag(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``maybe``: false for rows whose binary(32) ``digest`` certainly occurs once in rows (a written table)."""
    n = rows.count()
    bits = max(SEGMENT, min(max_bits, 1 << max(1, 16 * n).bit_length()))
    found = (
        rows.select("digest")
        .mapInPandas(_partial_filters(bits), "segment long, once binary, twice binary")
        .groupBy("segment")
        .applyInPandas(_merge_segment, "segment long, bitmap binary")
        .collect()  # bits / 8 bytes at most
    )
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for segment, bitmap in found:
        whole[segment * (SEGMENT // 8) : (segment + 1) * (SEGMENT // 8)] = np.frombuffer(bitmap, dtype=np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def maybe(digests: pd.Series) -> pd.Series:
        if not len(digests):
            return pd.Series([], dtype=bool)
        at = _probes(digests, bits)
        return pd.Series(((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1))

    return rows.withColumn("maybe", maybe("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest (SHA-256 of the normalised text)."""
    rows = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(normalised(text_of(text_col)), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-rows",
    )
    flagged = repeated_flag(rows, max_bits)
    suspects = materialise(flagged.filter("maybe").drop("maybe"), "exact-suspects")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    groups = suspects.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = materialise(groups.select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"), "exact-groups")
    met = suspects.join(groups, "digest").select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")
    alone = flagged.filter(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return alone.unionByName(met).withColumnRenamed("id", id_col)


def op9_exact_dedup(spark, sf_dir):
    found = exact_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
SQL = {
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, n.text_sha256 AS text_sha256
FROM n JOIN g ON n.text_sha256 = g.text_sha256
"""
}
