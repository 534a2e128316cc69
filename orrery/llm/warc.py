"""WARC archives: writing through Spark's text writer, reading with boundary-chain verification.

Writing: a row is a whole record (header, blank line, payload) and the writer's line separator is the pair of line ends
that closes a record, so each part file is a WARC file: uncompressed and splittable (as the query writes), or gzip of a bounded number of records. Of records with equal payloads of
at least 100 bytes, the one of the least page id is a response and the others revisit it; only payloads that a two-pass
Bloom filter finds possibly repeated are shuffled to learn that.

Reading: the text reader cuts at the magic ``WARC/1.1`` line, in one scan whose pieces are written with their places.
Tasks emit (record, successor) offsets from the record's own header, the place where the chain of successors leaves the
stretch (a split's bytes, cut every ``stretch_bytes``, whatever the compression), and numbers by which it can be told
whether a chain from one candidate comes by another. Pointer jumping over the exits, from the start of each file, keeps
the entries that are reachable, one a stretch; a piece is a record if the chain from its stretch's entry comes by it.
Magic inside payloads is never reached, and a record cut there is put together again from its pieces. What jumps is one
row a stretch and exit, not a row a record, and payloads of uncut records are not shuffled. A task holds one stretch.

Nulls: a null payload counts as empty, a null url gives no target line, a null page id is written as empty and read as
null. Rows that repeat both page id and payload are alike and have the same type. Empty table: empty result. A file whose
chain breaks raises an error, unless ``damaged`` is "keep". Other columns of records are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import discard, materialise, new_path, pages
from orrery.llm.exact_dedup import repeated_flag

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 100
RECORDS_A_FILE = 50_000


def with_revisits(records: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, size, type, refers_to) of records that read alike each time."""
    sized = records.select("page_id", "url", F.coalesce("payload", F.lit("")).alias("payload")).withColumn("hex", F.sha2("payload", 256)).withColumns({"digest": F.unhex("hex"), "size": F.octet_length("payload").cast("long")})
    flagged = repeated_flag(sized).withColumn("again", F.col("maybe") & (F.col("size") >= least))
    firsts = flagged.filter("again").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = materialise(firsts.select(F.col("digest").alias("key"), "first"), "warc-firsts")
    met = flagged.filter("again").join(firsts.hint("merge"), F.col("digest") == F.col("key"), "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    shape = lambda kind, first: ["page_id", "url", "payload", F.col("hex").alias("digest"), "size", kind.alias("type"), first.alias("refers_to")]
    seen = met.select(*shape(F.when(revisits, "revisit").otherwise("response"), F.when(revisits, F.col("first"))))
    none = F.lit(None).cast(records.schema["page_id"].dataType)
    return flagged.filter("NOT again").select(*shape(F.lit("response"), none)).unionByName(seen)


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_warc(records: DataFrame, path: str, compression: str = "none", records_a_file: int = RECORDS_A_FILE) -> None:
    """Write records of (page_id, url, payload, digest, size, type, refers_to) as WARC files under path. Uncompressed
    files are read in splits; gzip files are a third of the size but are read by one task each, so their records are
    bounded."""
    revisit = F.col("type") == "revisit"
    body = F.when(revisit, "").otherwise(F.col("payload"))
    url = F.regexp_replace("url", r"[\r\n]+", "%0A")
    record = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.col("type")), _line("WARC-Record-ID", _urn(F.col("page_id"))), _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")), _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), _line("WARC-Payload-Length", F.col("size").cast("string")),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))), _line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body,
    )
    records.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_a_file).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics: file, split, piece and, read from its header, the length of the record it would start."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("piece"))
    size = F.octet_length("piece").cast("long")
    head = F.substring_index("piece", END, 1)
    length = F.nullif(F.regexp_extract("head", r"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*$", 1), F.lit("")).try_cast("long")
    found = raw.withColumns({"size": size, "head": head}).withColumn("body", length)
    sound = (F.octet_length("head") < F.col("size")) & F.col("body").isNotNull() & F.rlike("head", F.lit("(?im)^warc-type:"))
    begins = F.octet_length("head") + len(END)
    return found.select("file", "split", "piece", "size", F.when(sound, begins).cast("long").alias("begins"), F.when(sound, F.col("body")).alias("body"))


def _numbers(at: list[int], ahead: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Of candidates in order of place, each with its successor's place: first and last number, exit and steps.

    Candidates of a stretch form trees whose parents are successors. They are numbered so that a chain from candidate e
    comes by candidate n if and only if first[n] <= first[e] <= last[n]."""
    n, spot = len(at), {a: k for k, a in enumerate(at)}
    up = [spot.get(b) for b in ahead]
    size, first, leaves, steps, free, count = [1] * n, [0] * n, list(ahead), [1] * n, [0] * n, 0
    for k, p in enumerate(up):  # a successor lies behind its record
        if p is not None:
            size[p] += size[k]
    for k in reversed(range(n)):
        p = up[k]
        if p is None:
            first[k], count = count, count + size[k]
        else:
            first[k], leaves[k], steps[k] = free[p], leaves[p], steps[p] + 1
            free[p] += size[k]
        free[k] = first[k] + 1
    return first, [a + b - 1 for a, b in zip(first, size)], leaves, steps


PLACED = "file string, split long, piece binary, size long, begins long, body long, stretch int, at long, next long, leaves long, first long, last long, steps long"


def _placed(stretch_bytes: int):
    """Cut each split into stretches, and give each piece the place of its magic from the stretch's first byte, and each
    candidate its successor and numbers; pieces come in the file's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, key, at, full, stretch = [], [], None, 0, 0, 0

        def emit() -> Iterator[pa.RecordBatch]:
            sound = [k for k, r in enumerate(rows) if r[1] is not None and r[2] is not None]
            nxt = [rows[k][0] + len(MAGIC) + rows[k][1] + rows[k][2] + len(END) for k in sound]
            first, last, leaves, steps = _numbers([rows[k][0] for k in sound], nxt)
            columns = {"stretch": [stretch] * len(rows), "at": [r[0] for r in rows]}
            for name, values in (("next", nxt), ("leaves", leaves), ("first", first), ("last", last), ("steps", steps)):
                columns[name] = [None] * len(rows)
                for k, v in zip(sound, values):
                    columns[name][k] = v
            done = 0
            for batch in held:
                more = [pa.array(v[done : done + len(batch)], pa.int32() if c == "stretch" else pa.int64()) for c, v in columns.items()]
                done += len(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *columns])

        for batch in batches:
            start = 0
            met = zip(*(batch.column(c).to_pylist() for c in ("file", "split", "size", "begins", "body")))
            for i, (f, s, size, begins, body) in enumerate(met):
                if (f, s) != key or full >= stretch_bytes:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if rows:
                        yield from emit()
                    stretch = stretch + 1 if (f, s) == key else 0
                    held, rows, key, at, full, start = [], [], (f, s), 0, 0, i
                # the first piece of a file follows no magic, and a later split's first piece follows the one before it
                rows.append((at - len(MAGIC), begins, body))
                at += size + len(MAGIC)
                full += size
            if start < len(batch):
                held.append(batch.slice(start))
        if rows:
            yield from emit()

    return run


def reachable(nodes: DataFrame) -> tuple[DataFrame, int]:
    """Of a written table of candidates (file, split, stretch, at, leaves, first, steps; absolute places) those where
    the chain from a file's start enters a stretch, as (file, split, stretch, entry, jump, first, steps); and the
    number of rounds of pointer jumping."""
    targets = nodes.select("file", F.col("leaves").alias("place")).unionByName(nodes.select("file", F.lit(0).cast("long").alias("place"))).distinct()
    met = nodes.join(targets.withColumnsRenamed({"file": "f"}).hint("merge"), (F.col("file") == F.col("f")) & (F.col("at") == F.col("place")))
    jumps = materialise(met.select("file", "split", "stretch", F.col("at").alias("entry"), "leaves", F.col("leaves").alias("jump"), (F.col("at") == 0).alias("hit"), "first", "steps"), "warc-jumps")
    rounds = 0
    while True:
        ahead = jumps.select(F.col("file").alias("f"), F.col("entry").alias("e"), F.col("jump").alias("further"))
        hits = jumps.filter("hit").select(F.col("file").alias("hf"), F.col("jump").alias("he")).distinct()
        step = jumps.join(ahead.hint("merge"), (F.col("file") == F.col("f")) & (F.col("jump") == F.col("e")), "left").join(hits.hint("merge"), (F.col("file") == F.col("hf")) & (F.col("entry") == F.col("he")), "left")
        step = step.select("file", "split", "stretch", "entry", "leaves", F.coalesce("further", "jump").alias("jump"), (F.col("hit") | F.col("he").isNotNull()).alias("hit"), "first", "steps", F.col("further").isNotNull().alias("moved"))
        moved = materialise(step, "warc-jumps")
        discard(jumps)
        jumps, rounds = moved, rounds + 1
        if jumps.filter("moved").isEmpty():
            break
    return jumps.filter("hit").select("file", "split", "stretch", "entry", "leaves", "first", "steps"), rounds


#: A stretch takes so many bytes (the last piece may go beyond); pieces of cut records meet by cells of this size.
STRETCH = 1 << 26
#: A table of one row a stretch is broadcast up to so many rows (some 150 bytes each); beyond, it is joined by sort and merge.
MOST_STRETCHES = 1_000_000


def read_warc(spark: SparkSession, path: str, damaged: str = "raise", stretch_bytes: int = STRETCH) -> DataFrame:
    """One row per record: file, offset, head (its header lines) and payload (binary).

    damaged: "raise" if the chain of some file breaks before the file's end or its last record is cut off, "keep" to return
    the records up to there."""
    scanned = _pieces(spark, path).withColumn("piece", F.col("piece").cast("binary"))
    # the one scan: places, numbers and bytes are written together, so later changes of splits can't part them
    pieces = materialise(scanned.select("file", "split", "piece", "size", "begins", "body").mapInArrow(_placed(stretch_bytes), PLACED), "warc-pieces")
    # the first magic of a file stands at 0, which is -len(MAGIC) plus that of its empty first piece
    lengths = pieces.groupBy("file", "split", "stretch").agg(F.sum(F.col("size") + len(MAGIC)).alias("length"))
    spread = lengths.selectExpr("file AS f", "split AS s", "stretch AS t", "length", "coalesce(sum(length) OVER (PARTITION BY file ORDER BY split, stretch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base")
    spread = materialise(spread, "warc-stretches")  # a row a stretch
    few = spread.count() <= MOST_STRETCHES
    beside = lambda df: F.broadcast(df) if few else df.hint("merge")
    own = (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")) & (F.col("stretch") == F.col("t"))
    nodes = pieces.filter("next IS NOT NULL").select("file", "split", "stretch", "at", "leaves", "first", "steps").join(beside(spread), own)
    nodes = materialise(nodes.select("file", "split", "stretch", *[(F.col(c) + F.col("base")).alias(c) for c in ("at", "leaves")], "first", "steps"), "warc-nodes")
    entries, _ = reachable(nodes)
    entries = materialise(entries, "warc-entries")
    if damaged == "raise":
        ends = spread.groupBy("f").agg((F.sum("length") - len(MAGIC)).alias("size")).join(entries.groupBy("file").agg(F.max("leaves").alias("end")).hint("merge"), F.col("f") == F.col("file"), "left")
        broken = ends.filter(~F.coalesce("end", F.lit(0)).between(F.col("size"), F.col("size") + len(END)) & (F.col("size") > 0)).select("f").take(3)
        if broken:
            raise ValueError(f"records and file don't end together: {', '.join(r.f for r in broken)}")
    # the chain from a file's start enters a stretch once at most, so a stretch stays one row
    entered = entries.select(F.col("file").alias("ef"), F.col("split").alias("es"), F.col("stretch").alias("et"), F.col("first").alias("entry"), F.col("steps").alias("wanted"))
    spread = materialise(spread.join(entered.hint("merge"), (F.col("f") == F.col("ef")) & (F.col("s") == F.col("es")) & (F.col("t") == F.col("et")), "left").select("f", "s", "t", "base", "entry", "wanted"), "warc-entered")
    met = pieces.join(beside(spread), own).withColumn("hit", F.coalesce(F.col("entry").between(F.col("first"), F.col("last")), F.lit(False))).withColumn("place", F.col("at") + F.col("base"))
    cut = F.col("begins") + F.col("body") > F.col("size")
    found, n_cut = met.agg(F.count_if("hit"), F.count_if(F.col("hit") & cut)).first()
    wanted = spread.agg(F.coalesce(F.sum("wanted"), F.lit(0))).first()[0]
    if found != wanted:
        raise RuntimeError(f"{wanted} records were verified, but {found} read")
    head = F.substring("piece", F.lit(1), F.col("begins") - len(END)).cast("string").alias("head")
    payload = F.substring("piece", F.col("begins") + 1, F.col("body")).alias("payload")
    plain = met.filter(F.col("hit") & ~cut).select("file", F.col("place").alias("offset"), head, payload)
    if not n_cut:
        return plain
    # each piece inside a cut record, that of its own magic first; none of the others is a record itself
    grid = lambda a, b: F.explode(F.sequence(F.floor(a / STRETCH), F.floor(b / STRETCH)))
    owners = met.filter(F.col("hit") & cut).select(F.col("file").alias("of"), F.col("place").alias("offset"), (F.col("next") + F.col("base")).alias("end")).withColumn("cell", grid(F.col("offset"), F.col("end") - 1))
    loose = met.filter(~F.col("hit") | cut).select("file", "place", "piece", "begins", "body", F.floor(F.col("place") / STRETCH).alias("at_cell"))
    parts = loose.join(owners.hint("merge"), (F.col("file") == F.col("of")) & (F.col("at_cell") == F.col("cell")) & (F.col("place") >= F.col("offset")) & (F.col("place") < F.col("end")))
    joined = parts.groupBy("file", "offset").agg(F.sort_array(F.collect_list(F.struct("place", "piece", "begins", "body"))).alias("p"))
    # one pass over the pieces: bytes are joined as hexadecimal text, which array_join takes
    glued = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["piece"])), MAGIC.encode().hex()))
    whole = joined.select("file", "offset", glued.alias("piece"), F.col("p")[0]["begins"].alias("begins"), F.col("p")[0]["body"].alias("body"))
    return plain.unionByName(whole.select("file", "offset", head, payload))


def field(name: str) -> Column:
    """A header field of the column ``head``; null if it is not there."""
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _page(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).try_cast("long")


def op2_warc(spark, sf_dir):
    path = new_path(spark, "warc")
    write_warc(with_revisits(pages(spark, sf_dir).select("page_id", "url", F.col("html").alias("payload"))), path)
    read = read_warc(spark, path)
    revisit = field("WARC-Type") == "revisit"
    return read.select(
        _page(field("WARC-Record-ID")).alias("page_id"),
        F.when(revisit, field("WARC-Payload-Length").try_cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(field("WARC-Payload-Digest"), ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        _page(field("WARC-Refers-To")).alias("refers_to"),
    )


QUERIES = {"op2_warc": op2_warc}
SQL = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest AS digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = digest
"""
}
