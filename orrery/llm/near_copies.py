"""Near copies: five-word shingles with a Jaccard similarity of 0.8 or more, found by SimHash tiles and checked exactly.

Documents of equal shingle sets collapse first. Candidates are then found in three rounds, each of which leaves out what
those before it joined; every candidate's similarity is computed exactly from the whole sets.

1. SimHash tiles: 64-bit fingerprints within three bits, as spanning forests instead of pairs.
2. Stars: documents that share one of their rarest shingles, each with the one in their midst, that is, whose fingerprint
   is nearest to the majority of theirs. Two sets of similarity s share an element among the first n - ceil(s n) + 1 of
   each in any common order (prefix filtering), so every such pair meets. Thousands of copies of one text are mostly
   joined here, to that text, without their pairs.
3. SimHash tiles again, of the groups of round 2 that are not one component: sets that are just 0.8 alike differ by about
   19 of 128 bits, where blocks of equal bits no longer separate anything, so tiles of documents that meet are compared
   by exclusive-or and bit counts within ``WIDE`` of 128 bits; tile pairs whose population counts differ by more are skipped.
   In small sets a few elements decide each bit: 3.5 of 10,000 pairs of 5 and 4 elements at 0.8 lie beyond ``WIDE``. So
   pairs with a set of up to ``SMALL`` elements are candidates whatever their bits. Of larger sets a pair of similarity
   0.8 lies beyond five deviations, about once in a million; one that shares nothing else lies within once in 50,000.
   Tiles give out their pairs while these are at most ``SPARSE`` a row, so their number grows with the rows. Those of
   denser tiles stay there: such a tile's sets are fetched once a row, and it gives a spanning forest of its links.

The order puts shingles last that many documents of a sample share, so that boilerplate seldom makes groups; the sample
decides only how much is compared.

Nulls: a null text counts as empty; empty texts equal one another. Up to five words are one shingle. Null ids come last.
Repeated rows are copies. Empty table: empty result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm import simhash
from orrery.llm.common import MOST_BESIDE, beside, discard, materialise
from orrery.llm.components import connected_components

SHINGLE = 5
#: The least similarity, as a fraction of whole numbers: comparisons stay exact.
PART, WHOLE = 4, 5
#: Of 128 bits, those within which the last round takes candidates: five deviations beyond the mean at similarity 0.8.
WIDE = 40
#: Sets of so few elements are compared by size and prefix alone.
SMALL = 32
TILE = 512
#: Tiles of so few rows are compared many at a time.
FEW = 8
#: A tile with at most so many pairs a row gives them out; the others' stay together for one forest a tile.
SPARSE = 4
SAMPLE = 20_000
#: A shingle in this many sampled documents goes last; of these at most MOST are broadcast (8 bytes each).
COMMON, MOST = 4, 1 << 20
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order; none for a text without words."""
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype="<u8")
    flat = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(flat, dtype=np.uint8) == 32).tolist()
    starts = [0, *(e + 1 for e in ends)]
    ends.append(len(flat))
    digest, k = xxhash.xxh64_intdigest, min(shingle, len(words))
    return np.unique(np.array([digest(flat[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])], dtype="<u8"))


def shingle_set(text_col: str) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).view("<i8") for t in texts])

    return run(text_col)


def _again(h: np.ndarray) -> np.ndarray:
    """Other hashes of the same elements: multiply, fold and multiply."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def marks(text_col: str, common) -> Column:
    """A digest of the set, its size, two fingerprints, and its elements up to the prefix's length, common ones last."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v

    @F.pandas_udf("digest string, n long, fp long, fp2 long, first array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        late, out = common.value, []
        for t in texts:
            s = shingles(t)
            often = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s if len(late) else np.zeros(len(s), dtype=bool)
            take = len(s) - (PART * len(s) + WHOLE - 1) // WHOLE + 1 if len(s) else 0
            prints = [signed(simhash.majority(h)) for h in (s, _again(s))] if len(s) else [0, 0]
            out.append((xxhash.xxh3_128_hexdigest(s.tobytes()), len(s), *prints, np.concatenate([s[~often], s[often]])[:take].view("<i8")))
        return pd.DataFrame(out, columns=["digest", "n", "fp", "fp2", "first"]).astype({"n": "int64", "fp": "int64", "fp2": "int64"})

    return run(text_col)


def common_shingles(texts: DataFrame, text_col: str, n_docs: int) -> np.ndarray:
    share = max(1, n_docs // SAMPLE)
    sample = texts.filter(F.pmod(F.xxhash64(F.col("__row")), F.lit(share)) == 0).select(F.explode(shingle_set(text_col)).alias("h"))
    often = sample.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "h").limit(MOST)
    return np.sort(np.array([r.h for r in often.select("h").toLocalIterator()], dtype="<i8").view("<u8"))


def _sets(rows: DataFrame, tagged: DataFrame, text_col: str) -> DataFrame:
    """(row, whole) of a written table of rows: only their texts are hashed again."""
    wanted = rows.withColumnRenamed("row", "__row")
    texts = tagged.select("__row", text_col).join(F.broadcast(wanted) if rows.count() <= MOST_BESIDE else wanted.hint("merge"), "__row", "left_semi")
    return materialise(texts.select(F.col("__row").alias("row"), shingle_set(text_col).alias("whole")), "near-sets")


def _alike(pairs: DataFrame, tagged: DataFrame, text_col: str) -> DataFrame:
    """Of a written table of candidate pairs (a, b) those whose whole sets are alike enough."""
    sets = _sets(materialise(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "near-rows"), tagged, text_col)
    side = lambda c: sets.select(F.col("row").alias(c), F.col("whole").alias(f"s{c}"))
    met = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    both = met.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("o"))
    links = materialise(both.filter(WHOLE * F.col("o") >= PART * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b"), "near-links")
    discard(sets)
    return links


#: The shingles of a row before the one it meets in, 31 bits of each, of its first eight.
EARLIER = tuple(f"e{k}" for k in range(8))
FIELDS = ("row", "n", "at", "fp", "fp2", "label", *EARLIER)


def _pairs(midst: bool):
    """Pairs of rows in a tile, or in two, that lie within WIDE bits, have sizes that allow it and are not joined yet: those
    with the row in the midst of a tile, as rows (a, b), or all of them, as a row (rows, pairs) a tile."""
    def near(a: dict, b: dict) -> np.ndarray:
        bits = np.bitwise_count((a["fp"] ^ b["fp"]).view(np.uint64)) + np.bitwise_count((a["fp2"] ^ b["fp2"]).view(np.uint64))
        small = np.minimum(a["n"], b["n"]) <= SMALL
        return ((bits <= WIDE) | small) & (a["label"] != b["label"]) & (WHOLE * np.minimum(a["n"], b["n"]) >= PART * np.maximum(a["n"], b["n"]))

    def centre(x: dict) -> np.ndarray:
        """The place, along the last axis, of the row whose fingerprint is nearest to the majority of its tile's."""
        bits = np.unpackbits(np.stack([x["fp"], x["fp2"]], axis=-1).view(np.uint8), axis=-1)
        most = 2 * bits.sum(axis=-2, dtype=np.int64, keepdims=True) > bits.shape[-2]
        return (bits != most).sum(axis=-1).argmin(axis=-1)

    def fields(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        tiles = batch.column(0)
        inner = tiles.values
        outer, cuts = tiles.offsets.to_numpy(), inner.offsets.to_numpy()
        return outer[:-1], outer[1:] - 1, cuts, {k: inner.values.field(k).to_numpy() for k in FIELDS}

    def few(first: np.ndarray, last: np.ndarray, cuts: np.ndarray, columns: dict) -> Iterator[dict]:
        """The tiles of up to FEW rows that are compared with themselves, a table of (tiles, rows) for each size."""
        n = cuts[first + 1] - cuts[first]
        for k in range(2, FEW + 1):
            at = cuts[first[(first == last) & (n == k)]]
            if len(at):
                yield {c: v[at[:, None] + np.arange(k)] for c, v in columns.items()}

    def others(first: np.ndarray, last: np.ndarray, cuts: np.ndarray, columns: dict) -> Iterator[tuple[dict, dict, bool]]:
        for f, e in zip(first.tolist(), last.tolist()):
            if f != e or cuts[f + 1] - cuts[f] > FEW:
                x, y = ({k: v[cuts[j] : cuts[j + 1]] for k, v in columns.items()} for j in (f, e))
                yield x, y, f == e

    def apart(x: dict, y: dict) -> np.ndarray:
        """Pairs with enough elements left from here on, if they share none before; those that do are compared where they
        meet first. (Different shingles of equal 31 bits would lose the pair: one in 30 million pairs.)"""
        need = PART * (x["n"] + y["n"])
        ok = ((PART + WHOLE) * (x["n"] - x["at"]) >= need) & ((PART + WHOLE) * (y["n"] - y["at"]) >= need)
        for k in EARLIER:
            for m in EARLIER:
                ok &= (x[k] != y[m]) | (x[k] == -1)
        return ok

    def links(p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], names=["a", "b"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = fields(batch)
            for x in few(*parts):
                at = centre(x)
                own = {k: np.take_along_axis(v, at[:, None], axis=1) for k, v in x.items()}
                t, j = np.nonzero(near(own, x))
                yield links(own["row"][t, 0], x["row"][t, j])
            for x, y, _ in others(*parts):
                at = centre(x)
                j = np.flatnonzero(near({k: v[at] for k, v in x.items()}, y))
                if len(j):
                    yield links(np.full(len(j), x["row"][at]), y["row"][j])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = fields(batch)
            for x in few(*parts):
                i, j = np.triu_indices(x["row"].shape[1], 1)
                a, b = ({k: v[:, at] for k, v in x.items()} for at in (i, j))
                found = near(a, b)
                a, b = ({k: v[found] for k, v in side.items()} for side in (a, b))
                new = apart(a, b)
                rows, n = np.stack([a["row"][new], b["row"][new]], axis=1).ravel(), int(new.sum())
                ends = pa.array(np.arange(0, 2 * n + 1, 2, dtype=np.int32))
                pairs = pa.array(np.tile(np.array([0, 1], dtype=np.int32), n))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(rows)), pa.ListArray.from_arrays(ends, pairs)], names=["rows", "pairs"])
            for x, y, alone in others(*parts):
                i, j = np.nonzero(near({k: v[:, None] for k, v in x.items()}, y))
                if alone:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    new = apart({k: v[i] for k, v in x.items()}, {k: v[j] for k, v in y.items()})
                    i, j = i[new], j[new]
                if len(i):
                    rows, at = np.unique(np.stack([x["row"][i], y["row"][j]], axis=1), return_inverse=True)
                    yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([at.ravel().astype(np.int32)])], names=["rows", "pairs"])

    return stars if midst else hits


def _forest(sets: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
    """Of a tile's pairs of rows, links that join all that are alike enough."""
    whole, links = {r: np.sort(w) for r, w in zip(sets["row"], sets["whole"])}, []
    rows, pairs = hits["rows"].iloc[0], hits["pairs"].iloc[0].reshape(-1, 2)
    lead = list(range(len(rows)))

    def top(k: int) -> int:
        while lead[k] != k:
            lead[k] = k = lead[lead[k]]
        return k

    for i, j in pairs.tolist():
        p, q = top(i), top(j)
        if p != q:
            a, b = whole[rows[i]], whole[rows[j]]
            o = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if WHOLE * o >= PART * (len(a) + len(b) - o):
                lead[p] = q
                links.append((rows[i], rows[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _joined(links: DataFrame, named: DataFrame, tag: str) -> DataFrame:
    """The labelled rows with the label of their new component. Links are those found since the labels were: they are
    contracted to links between labels, each once, so that a round's components never repeat those before it."""
    of = lambda c: named.select(F.col("row").alias(c), F.col("label").alias(f"label_{c}"))
    between = links.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), "b").filter("label_a <> label_b")
    ends = between.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct()
    labels = connected_components(ends).select("node", F.col("label").alias("least"))
    met = named.join(labels.hint("merge"), named.label == labels.node, "left")
    return materialise(met.select(*[c for c in named.columns if c != "label"], F.coalesce("least", "label").alias("label")), tag)


def _meetings(named: DataFrame, tag: str) -> DataFrame:
    """(h, item, ones): rows by the shingles they meet in, of the groups that are not one component yet."""
    groups = named.select(F.explode("first").alias("h"), "label").groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = materialise(groups.filter("lo <> hi").select("h"), "near-mixed")
    # most elements meet nobody, so they travel without the fields that only meetings need
    flat = named.select("row", F.posexplode("first").alias("at", "h"))
    narrow = materialise(flat.join(mixed.hint("merge"), "h", "left_semi"), "near-narrow")
    first = [F.coalesce(F.get("first", F.lit(k)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"), F.lit(-1)).alias(name) for k, name in enumerate(EARLIER)]
    flat = narrow.join(named.select("row", "n", "fp", "fp2", "label", *first).hint("merge"), "row")
    earlier = [F.when(F.col("at") > k, F.col(name)).otherwise(-1).alias(name) for k, name in enumerate(EARLIER)]
    flat = flat.select("h", F.struct("row", "n", "at", "fp", "fp2", "label", *earlier).alias("item"))
    met = materialise(flat.withColumn("ones", F.bit_count("item.fp") + F.bit_count("item.fp2")), tag)
    discard(mixed, narrow)
    return met


def near_labels(rows: DataFrame, tagged: DataFrame, text_col: str) -> DataFrame:
    """(row, label) of a written table (row, n, fp, fp2, first), a row a distinct set: the least row of the component
    that all pairs alike enough make."""
    prints = materialise(rows.groupBy("fp").agg(F.min("row").alias("least")), "near-prints")
    close = materialise(simhash.near_links(prints.select("fp"), simhash.RADIUS), "near-close")
    of = lambda c: prints.select(F.col("fp").alias(c), F.col("least").alias(f"row_{c}"))
    pairs = close.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), "b").select(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
    equal = rows.join(prints.hint("merge"), "fp").filter("row <> least").select(F.col("least").alias("a"), F.col("row").alias("b"))
    links = _alike(materialise(pairs.unionByName(equal), "near-pairs"), tagged, text_col)

    named = _joined(links, rows.withColumn("label", F.col("row")), "near-labelled")
    met = _meetings(named, "near-meetings")
    stars = simhash.tiled(met, ["h"], "item", WIDE, TILE).mapInArrow(_pairs(True), "a long, b long").distinct()
    links = _alike(materialise(stars, "near-midst"), tagged, text_col)
    before, named = named, _joined(links, named, "near-labelled")
    discard(before, met)

    met = _meetings(named, "near-meetings")
    hits = simhash.tiled(met, ["h"], "item", WIDE, TILE).mapInArrow(_pairs(False), "rows array<long>, pairs array<int>")
    hits = materialise(hits.withColumn("tile", F.monotonically_increasing_id()), "near-hits")
    sparse = F.size("pairs") <= 2 * SPARSE * F.size("rows")
    row = lambda k: F.get("rows", F.get("pairs", k))
    ends = F.transform(F.sequence(F.lit(0), F.size("pairs") - 2, F.lit(2)), lambda k: F.struct(row(k).alias("p"), row(k + 1).alias("q")))
    few = hits.filter(sparse).select(F.explode(ends).alias("e")).select(F.least("e.p", "e.q").alias("a"), F.greatest("e.p", "e.q").alias("b")).distinct()
    links = _alike(materialise(few, "near-few"), tagged, text_col)
    dense = hits.filter(~sparse)
    held = dense.select(F.col("tile").alias("own"), F.explode("rows").alias("row"))
    sets = _sets(materialise(held.select("row").distinct(), "near-rows"), tagged, text_col)
    filled = held.join(sets.hint("merge"), "row")
    found = filled.groupBy("own").cogroup(dense.groupBy("tile")).applyInPandas(_forest, "a long, b long")
    links = links.unionByName(materialise(found, "near-links"))
    labels = _joined(links, named.select("row", "label"), "near-named")
    discard(named, met, hits, sets)
    return labels


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays: that of the least id (null ids last; of repeated rows, one)."""
    tagged = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "near-docs")
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(tagged, text_col, tagged.count()))
    marked = tagged.select(F.col("__row").alias("row"), F.col(id_col).alias("id"), marks(text_col, common).alias("m")).select("row", "id", "m.*")
    marked = materialise(marked, "near-marks")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("first")
    heads = materialise(marked.groupBy("digest").agg(first).select("first", F.col("first.row").alias("row")), "near-heads")
    rows = materialise(marked.select("row", "n", "fp", "fp2", "first").join(heads.select("row").hint("merge"), "row", "left_semi"), "near-sets")
    met = heads.join(near_labels(rows, tagged, text_col).hint("merge"), "row").select("first", "label")
    kept = met.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    gone = materialise(marked.select("row").join(materialise(kept, "near-kept").hint("merge"), "row", "left_anti").select(F.col("row").alias("__row")), "near-gone")
    return tagged.join(beside(gone), "__row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
