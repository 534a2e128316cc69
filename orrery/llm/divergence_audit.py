"""How far the sources of a language lie apart in their words, exactly, from joint count histograms.

Terms are runs of ASCII letters and characters beyond ASCII, A to Z lower-cased. A language keeps the V terms that stand
in at least ``least`` of its documents. A group (language, source) gives a kept term with c occurrences the share
p = 1 + floor(10^9 (c + 2) / (N + 2 V)), N being the group's occurrences of all kept terms; the language itself likewise.
Two shares differ by f(p, q) = floor((p - q)^2 / (p + q)).

``pairs``: for two sources, terms with the same two counts differ by the same f. So per pair the distinct (count, count)
combinations are tallied, and f is evaluated once for each and multiplied by its tally. Only terms that both sources have
are joined; the cells with a zero are implied: (c, 0) holds the first source's terms with count c, less those that both
have, and (0, 0) what is left of V. Sums are kept as signed tallies, so each part is one partial aggregation.
``terms``: for a group, its terms above the language's share, by f.

Occurrences are counted inside tasks before they are shuffled (``ENTRIES`` counters at most, and one document's distinct
words), so a source or a word that holds much of the corpus sends a row a task. A join key (language, term) has a row a
source at most. The result has a row a pair of sources, so the number of sources of a language bounds the work. Numbers
are exact: 10^9 c is taken in 38 digits, all else fits 64 bits.

Nulls: null text, language and source count as empty. Groups without terms, and languages without kept terms, have their
pairs too (value 0 if V is 0). Repeated rows count as documents. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.common import beside, documents, materialise, space_cuts, text_of

LEAST = 10
TOP = 10
SCALE = 1_000_000_000
ENTRIES = 300_000
#: Bytes of a text to terms between spaces: A to Z lower-cased, everything in ASCII that is no letter a space.
TO_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))

TALLIES = "lang string, source string, term binary, n long, docs long"


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts; a row without term tells that a group occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = [None, *n]
            columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, n)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        held.clear()

    entries = 0
    for batch in batches:
        for lang, source, raw in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for piece in space_cuts(raw.as_py().translate(TO_TERMS)):
                words = piece.split()
                n.update(words)
                fresh = set(words) - seen
                docs.update(fresh)
                seen |= fresh
            entries += len(n) - before
            if entries > ENTRIES:
                yield from rows()
                entries = 0
    yield from rows()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs) in a written table, and a row with null term for each group."""
    read = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).cast("binary").alias("text"))
    tallies = read.mapInArrow(_tallies, TALLIES)
    return materialise(tallies.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")


def share(count: Column, total: Column, size: Column) -> Column:
    """p of a count among ``total`` occurrences of ``size`` kept terms."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return 1 + F.call_function("div", scaled, F.greatest(total + 2 * size, F.lit(1)).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Rows of (lang, source, part, item, value, rank): part 'pair' for all other sources of the language, part 'term' for
    the ``top`` terms that set a group apart from its language."""
    counts = term_counts(docs, lang_col, source_col, text_col)
    found = counts.filter(F.col("term").isNotNull())
    terms = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least)
    terms = materialise(terms.drop("docs"), "divergence-terms")
    kept = found.select("lang", "source", "term", "n").join(terms, ["lang", "term"])
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("total", "size", "lang_total")}
    groups = materialise(groups.withColumns(zero).withColumn("g", F.monotonically_increasing_id()), "divergence-groups")
    kept = materialise(kept.join(beside(groups), ["lang", "source"]), "divergence-kept")
    return _pairs(groups, kept).unionByName(_terms(kept, top))


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    as_ = lambda df, side, columns: df.select("lang", *[F.col(c).alias(f"{side}_{c}") for c in columns])
    members = ["g", "source", "total"]
    pairs = as_(groups, "a", members).join(as_(groups, "b", members), "lang").filter("a_g < b_g")
    pairs = materialise(pairs.join(beside(materialise(groups.groupBy("lang").agg(F.first("size").alias("size")), "divergence-sizes")), "lang"), "divergence-pairs")
    # tallies of (a, b, count in a, count in b), signed
    met = as_(kept, "a", ["term", "g", "n"]).join(as_(kept, "b", ["term", "g", "n"]).withColumnRenamed("lang", "b_lang"), (F.col("lang") == F.col("b_lang")) & (F.col("a_term") == F.col("b_term")) & (F.col("a_g") < F.col("b_g")))
    both = materialise(met.groupBy("a_g", "b_g", "a_n", "b_n").agg(F.count(F.lit(1)).alias("m")), "divergence-joint")
    none = F.lit(0).cast("long")
    cell = lambda a, b, m: F.struct(a.alias("a_n"), b.alias("b_n"), m.alias("m"))
    spread = lambda df, *cells: df.select("a_g", "b_g", F.explode(F.array(*cells)).alias("c")).select("a_g", "b_g", "c.*")
    a, b, m = F.col("a_n"), F.col("b_n"), F.col("m")
    cells = spread(both, cell(a, b, m), cell(a, none, -m), cell(none, b, -m), cell(none, none, m))
    single = materialise(kept.groupBy("g", "n").agg(F.count(F.lit(1)).alias("m")), "divergence-single")
    of_a = pairs.select("a_g", "b_g").join(single.select(F.col("g").alias("a_g"), F.col("n").alias("a_n"), "m"), "a_g")
    of_b = pairs.select("a_g", "b_g").join(single.select(F.col("g").alias("b_g"), F.col("n").alias("b_n"), "m"), "b_g")
    cells = cells.unionByName(spread(of_a, cell(a, none, m), cell(none, none, -m))).unionByName(spread(of_b, cell(none, b, m), cell(none, none, -m)))
    cells = cells.unionByName(spread(pairs, cell(none, none, F.col("size"))))
    tallied = cells.groupBy("a_g", "b_g", "a_n", "b_n").agg(F.sum("m").alias("m")).filter("m <> 0")
    shares = tallied.join(pairs.select("a_g", "b_g", "a_total", "b_total", "size"), ["a_g", "b_g"])
    value = gap(share(a, F.col("a_total"), F.col("size")), share(b, F.col("b_total"), F.col("size"))) * m
    values = shares.groupBy("a_g", "b_g").agg(F.sum(value).alias("value"))
    valued = pairs.join(values, ["a_g", "b_g"], "left").withColumn("value", F.coalesce("value", none))
    side = lambda own, other: F.struct(F.col(f"{own}_source").alias("source"), F.col(f"{other}_source").alias("item"))
    rows = valued.select("lang", F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _terms(kept: DataFrame, top: int) -> DataFrame:
    rows = kept.withColumn("p", share(F.col("n"), F.col("total"), F.col("size"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("size"))).filter("n > 0 AND p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def op11_divergence_audit(spark, sf_dir):
    return divergence(documents(spark, sf_dir))


QUERIES = {"op11_divergence_audit": op11_divergence_audit}
SQL = {
    "op11_divergence_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), v AS (
  SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM k GROUP BY lang
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, w.source, w.term
), g AS (
  SELECT d.lang, d.source, coalesce(max(v.v), 0) AS v FROM d LEFT JOIN v ON d.lang = v.lang GROUP BY d.lang, d.source
), s AS (
  SELECT g.lang, g.source, g.v, coalesce(sum(c.n), 0)::BIGINT AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source, g.v
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.total + 2 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (v.lang_total + 2 * v.v) AS q
  FROM s JOIN k ON s.lang = k.lang JOIN v ON v.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM rows_
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
}
