"""Line dedup by content-defined chunks of lines, with DataFrame functions alone.

A text's lines are hashed; a polynomial rolling hash over the last three line hashes ends a chunk where it is divisible
by ``divisor``, so boundaries depend on content and survive shifts. Of chunks of two or more lines (not all blank) that
occur more than once anywhere, the first occurrence (least id, then place) stays; the others are removed after their
bytes were compared with it. Repeats inside one document count as well.

Chunk digests are grouped with partial minima; the joins on digests run over written tables, so that adaptive execution
splits a chunk which a third of the documents hold. These joins are always by sort and merge: their sides grow with the corpus, and a
plan that broadcasts while they are small would move text only beyond some size. A document's removals are gathered per document only.

Nulls: a null text stays null and counts as empty. Null ids come after all others. Rows that repeat both id and text
are one document and are treated alike. Empty table: empty result. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import documents, materialise, text_of

DIVISOR = 3
MODULUS = 2147483647


def _before(values: Column, n: int) -> Column:
    """The array moved n places to the right, with zeros first."""
    return F.slice(F.concat(F.array_repeat(F.lit(0).cast("long"), n), values), F.lit(1), F.size(values))


def chunked(docs: DataFrame, text: Column, divisor: int = DIVISOR) -> DataFrame:
    """Add ``__chunks``: (start, n, body) of each chunk, in order."""
    lines = docs.withColumn("__lines", F.split(text, "\n", -1))
    hashed = lines.withColumn("__h", F.transform("__lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")))
    h = F.col("__h")
    rolled = F.zip_with(F.zip_with(h, _before(h, 1), lambda a, b: a + 31 * b), _before(h, 2), lambda a, b: F.pmod(a + 961 * b, F.lit(MODULUS)))
    marked = hashed.withColumn("__r", rolled).drop("__h")
    last = F.size("__lines") - 1
    spots = F.transform("__r", lambda r, i: F.when((F.pmod(r, F.lit(divisor)) == 0) | (i == last), i))
    ended = marked.withColumn("__ends", F.filter(spots, lambda i: i.isNotNull())).drop("__r")
    ends = F.col("__ends")
    starts = F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda e: e + 1))
    spans = ended.withColumn("__spans", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n"))))
    body = lambda x: F.array_join(F.slice("__lines", x["start"] + 1, x["n"]), "\n")
    return spans.withColumn("__chunks", F.transform("__spans", lambda x: F.struct(x["start"].alias("start"), x["n"].alias("n"), body(x).alias("body")))).drop("__ends", "__spans", "__lines")


def repeated_chunks(docs: DataFrame, id_col: str, text_col: str, divisor: int = DIVISOR) -> DataFrame:
    """(id, mark, starts): per document (its id and a digest of its text), the starts of the chunks to remove."""
    base = docs.select(F.col(id_col).alias("id"), F.md5(text_of(text_col)).alias("mark"), text_of(text_col).alias("text"))
    whole = chunked(base, F.col("text"), divisor).select("id", "mark", F.explode(F.filter("__chunks", lambda c: (c["n"] >= 2) & F.rlike(c["body"], F.lit(r"[^\x20\x09-\x0D]")))).alias("c"))
    chunks = whole.select("id", "mark", F.col("c.start").alias("start"), F.md5("c.body").alias("digest"), F.col("c.body").alias("body"))
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("mark").alias("mark"), F.col("start").alias("start"))
    groups = chunks.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = materialise(groups.select(F.col("digest").alias("key"), "first"), "line-groups")
    found = materialise(chunks.join(groups.hint("merge"), F.col("digest") == F.col("key")).withColumn("leads", place == F.col("first")).drop("key", "first"), "line-chunks")
    heads = materialise(found.filter("leads").select(F.col("digest").alias("key"), F.col("body").alias("original")).dropDuplicates(["key"]), "line-heads")
    same = found.filter("NOT leads").join(heads.hint("merge"), (F.col("digest") == F.col("key")) & (F.col("body") == F.col("original")))
    return same.groupBy("id", "mark").agg(F.collect_set("start").alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, removed_col: str | None = None) -> DataFrame:
    """The documents without repeated chunks; removed_col, if named, gets the number of removed lines."""
    gone = materialise(repeated_chunks(docs, id_col, text_col, divisor), "line-removals").withColumnsRenamed({"id": "__id", "mark": "__gone", "starts": "__starts"})
    marked = docs.withColumn("__mark", F.md5(text_of(text_col)))
    met = marked.join(gone.hint("merge"), marked[id_col].eqNullSafe(gone["__id"]) & (marked["__mark"] == gone["__gone"]), "left").drop("__id", "__gone", "__mark")
    cut = chunked(met, text_of(text_col), divisor)
    stays = F.filter("__chunks", lambda c: ~F.array_contains("__starts", c["start"]))
    left = F.when(F.col("__starts").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stays, lambda c: c["body"]), "\n"))
    lost = F.filter("__chunks", lambda c: F.array_contains(F.coalesce("__starts", F.array().cast("array<int>")), c["start"]))
    out = [left.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if removed_col:
        out.append(F.aggregate(lost, F.lit(0).cast("long"), lambda acc, c: acc + c["n"]).alias(removed_col))
    return cut.select(*out)


def op7_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("n_lines", F.size(F.split(text_of(), "\n", -1)).cast("long"))
    found = dedup_lines(docs, removed_col="n_removed")
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(text_of(), 256).alias("text_sha256"))


QUERIES = {"op7_line_dedup": op7_line_dedup}
SQL = {
    "op7_line_dedup": r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i, len(lines) AS n_lines FROM d
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l
), r AS (
  SELECT *, (h + 31 * coalesce(lag(h, 1) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 2147483647 AS r FROM h
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), e AS (
  SELECT *, coalesce(sum(CASE WHEN r % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r
), c AS (
  SELECT doc_id, chunk, min(i) AS start, count(*) AS n, max(n_lines) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM e GROUP BY doc_id, chunk
), p AS (
  SELECT *, n >= 2 AND regexp_matches(body, '[^\x20\x09-\x0D]') AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, start) > 1 AS gone FROM c
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY start) FILTER (NOT gone), '')) AS text_sha256
FROM p GROUP BY doc_id
"""
}
