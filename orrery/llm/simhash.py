"""SimHash near-dedup: exact comparison of fingerprints in tiles.

Fingerprints are 64-bit SimHashes of word shingles. Equal fingerprints collapse first (counted with partial sums), so
large groups of copies are one row from there on. Two fingerprints within the radius r agree on at least one of r + 1
blocks of bits, so distinct fingerprints are grouped by block value; a group is cut into tiles of about ``tile`` rows,
large groups by population count. Tile pairs whose population counts differ beyond the radius are skipped, all others
are compared exactly with numpy exclusive-or and bit counts. A comparison reports a spanning forest of what it finds,
never all pairs, so a group of thousands of near copies gives thousands of links; components follow by label
propagation over written tables.

Nulls: a null text counts as empty and has fingerprint zero, linked like any other; null ids never name a component
unless all its ids are null. Repeated rows share a fingerprint and each gives a row. Empty table: empty result. Other
columns are ignored. ``near_copies`` builds the pipeline's stage on these tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import documents, materialise
from orrery.llm.components import connected_components

RADIUS = 3
TILE = 4096
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: str | None, shingle: int = 3) -> int:
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(flat, SEED)]
    else:
        ends = np.flatnonzero(np.frombuffer(flat, dtype=np.uint8) == 32).tolist()
        starts = [0, *(e + 1 for e in ends)]
        ends.append(len(flat))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    return majority(np.array(hashes, dtype="<u8"))


def majority(whole: np.ndarray) -> int:
    """The number whose bits are those set in over half the hashes."""
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(whole), 1 << 16):
        part = whole[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(whole), bitorder="little").view("<u8")[0])


def fingerprint(text_col: str, shingle: int = 3) -> Column:
    """The SimHash as a long, its bits those of the unsigned value."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype="<u8").view("<i8"))

    return run(text_col)


def _forest(x: np.ndarray, y: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that join whatever lies within the radius inside x (y None), or between x and y, with a spanning forest."""
    n = len(x)
    z = x if y is None else np.concatenate([x, y])
    hit_rows = []
    other = x if y is None else y
    step = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, n, step):
        near = np.bitwise_count(x[at : at + step, None] ^ other[None, :]) <= radius
        if y is None:
            near[np.arange(len(near)), np.arange(at, at + len(near))] = False
        hit_rows.append(near.any(axis=1))
    rows = np.flatnonzero(np.concatenate(hit_rows))
    if not len(rows):
        return []
    open_ = np.ones(len(z), dtype=bool)
    links = []
    for root in rows.tolist():
        if not open_[root]:
            continue
        open_[root] = False
        front = [root]
        while front:
            i = front.pop()
            if y is None:
                left = np.flatnonzero(open_)
            else:
                left = np.flatnonzero(open_[n:]) + n if i < n else np.flatnonzero(open_[:n])
            got = left[np.bitwise_count(z[left] ^ z[i]) <= radius]
            open_[got] = False
            links += [(i, j) for j in got.tolist()]
            front += got.tolist()
    return [(int(z[i]), int(z[j])) for i, j in links]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tiles in batch["tiles"]:
                tiles = [np.asarray(t, dtype=np.int64).view(np.uint64) for t in tiles]
                if len(tiles) == 2:
                    out += _forest(tiles[0], tiles[1], radius)
                elif len(tiles[0]) <= 8:
                    ints = tiles[0].tolist()
                    out += [(p, q) for k, p in enumerate(ints) for q in ints[k + 1 :] if (p ^ q).bit_count() <= radius]
                else:
                    out += _forest(tiles[0], None, radius)
            yield pd.DataFrame(np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return run


def tiled(rows: DataFrame, keys: list[str], item: str, radius: int, tile: int) -> DataFrame:
    """(tiles): one or two arrays of items to compare, so that all pairs of rows of equal keys are compared whose
    population counts (column ``ones``) differ by no more than the radius; larger groups are cut into many tiles."""
    sizes = rows.groupBy(*keys, "ones").agg(F.count(F.lit(1)).alias("n"))
    wide = sizes.groupBy(*keys).agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("ones", "n"))).alias("by_ones")).filter(F.col("total") > 1)
    wide = materialise(wide, "simhash-groups")
    met = rows.join(wide, keys)
    big = F.col("total") > tile
    parts = lambda ones: F.greatest(F.ceil(F.col("by_ones")[ones] / tile), F.lit(1)).cast("int")
    tiles = (
        met.withColumn("band", F.when(big, F.col("ones")).otherwise(-1))
        .withColumn("part", F.when(big, F.pmod(F.xxhash64(item), parts(F.col("ones")))).otherwise(0).cast("int"))
        .groupBy(*keys, "band", "part")
        .agg(F.collect_list(item).alias("tile"), F.first("by_ones").alias("by_ones"))
    )
    tiles = materialise(tiles, "simhash-tiles")
    small = tiles.filter("band < 0").select(F.array("tile").alias("tiles"))
    code = lambda band, part: band.cast("long") * (1 << 32) + part
    bands = F.filter(F.sequence(F.col("band") - radius, F.col("band") + radius), lambda b: F.map_contains_key("by_ones", b))
    near = F.flatten(F.transform(bands, lambda b: F.transform(F.sequence(F.lit(0), parts(b) - 1), lambda p: code(b, p))))
    own = code(F.col("band"), F.col("part"))
    large = tiles.filter("band >= 0").select(*keys, "tile", own.alias("own"), F.explode(near).alias("other"))
    pairs = large.groupBy(*keys, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(F.collect_list("tile").alias("tiles"))
    return small.unionByName(pairs.select("tiles"))


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp, each once) whose components are those of all pairs
    within the radius."""
    blocks = radius + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)).alias("value"))
        for i in range(blocks)
    ]
    rows = prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*keys)).alias("k")).select("k.block", "k.value", "fp", "ones")
    return tiled(rows, ["block", "value"], "fp", radius, tile).mapInPandas(_compare(radius), "a long, b long")


def near_groups(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Add component_id, the least id reachable, to a written table of (id, fp, ...)."""
    prints = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    links = materialise(near_links(prints.select("fp"), radius, tile), "simhash-links")
    labels = connected_components(links)
    met = prints.join(labels, prints.fp == labels.node, "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    met = materialise(met, "simhash-members")
    heads = met.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialise(met.join(heads, "label").select(F.col("fp").alias("own"), "component_id"), "simhash-named")
    return rows.join(named, rows.fp == named.own).drop("own")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op4_simhash(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = materialise(docs.select(F.col("doc_id").alias("id"), fingerprint("text").alias("fp")), "simhash-rows")
    return near_groups(rows).select(F.col("id").alias("doc_id"), hex_print(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash": op4_simhash}
SQL: dict[str, str] = {}
