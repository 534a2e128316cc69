"""Token-id files of fixed-width bit-packed ids.

``write_packed`` encodes whole texts with the tokenizers library, ends each document with ``end_id`` and writes shards
in ascending order of the ids of documents (nulls last); ``read_packed`` gives the documents back, ``numbered`` adds the
place of each in the whole sequence, ``ids_at`` takes any slice out of a shard's bytes without unpacking the rest.

A shard is a file ``part-NNNNN-*`` of the folder; NNNNN gives the shards' order. It consists of
- blocks of ``block_ids`` ids (the last may hold fewer), each id in ``bits`` bits, low bits first, padded to a byte; the
  width is the least that holds the vocabulary (16 for 50,257 ids);
- a footer: per document the length of its id as text (4 bytes, all ones for null) and its count of ids (8 bytes), then
  the ids as text in UTF-8, then the blocks' offsets in the file (8 bytes each, one more for the end);
- a trailer of 48 bytes: footer's offset, documents, ids, blocks (8 bytes each), bits, ids a block (4 bytes each) and the
  magic. All numbers are little-endian. A line feed follows each block and the trailer, as Spark's text writer puts it.

Documents are dealt by range of (id, hash of the text, place in the input), so many rows of one id are split too, and
rows that are equal in id and text are interchangeable; no order depends on how rows arrive. A task holds one block and
the footer of its shard (some 12 million characters of text).

Encoding: ids depend on a pre-token alone, and between a character that isn't white space and a single space before
another such character there is always a border of pre-tokens. So texts are cut there, pieces are encoded once by the
library and remembered (``MEMO`` pieces at most, in the Python worker, for its later tasks too), and what has no such
border is encoded whole. Strings of special tokens in a text are ordinary text. An id beyond the width is an error.

Nulls: a null text counts as empty (only the end id); null ids come last. Repeated rows are documents like others. An
empty table gives a folder without shards and reads as empty. Other columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.common import beside, documents, materialise, new_path, text_of

MAGIC = b"ORRPACK\x01"
TRAILER = "<QQQQII8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
BLOCK_IDS = 1 << 16
SHARD_CHARS = 12_000_000
MEMO = 800_000
NULL = 0xFFFFFFFF


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, low bits first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    raw = ids.astype("<u4").view(np.uint8)
    if bits % 8 == 0:  # whole bytes: the same layout without a detour over bits
        return raw.reshape(-1, 4)[:, : bits // 8].tobytes()
    wide = np.unpackbits(raw, bitorder="little").reshape(-1, 32)
    return np.packbits(wide[:, :bits], bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block."""
    if bits % 8 == 0:
        whole = np.zeros((n, 4), dtype=np.uint8)
        whole[:, : bits // 8] = np.frombuffer(raw, np.uint8, n * bits // 8).reshape(n, bits // 8)
        return whole.ravel().view("<u4")
    flat = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, bitorder="little").view("<u4")


class Shard:
    """A shard's bytes: documents, and ids by place."""

    def __init__(self, content: bytes):
        self.content = content
        if len(content) <= TRAILER_BYTES or content[-9:] != MAGIC + b"\n":
            raise ValueError("a shard is cut or no shard")
        self.footer, self.n_docs, self.n_ids, self.n_blocks, self.bits, self.block_ids, _ = struct.unpack(TRAILER, content[-1 - TRAILER_BYTES : -1])
        at = self.footer
        self.id_sizes = np.frombuffer(content, "<u4", self.n_docs, at)
        at += 4 * self.n_docs
        self.counts = np.frombuffer(content, "<u8", self.n_docs, at).astype(np.int64)
        at += 8 * self.n_docs
        text = np.where(self.id_sizes == NULL, 0, self.id_sizes).astype(np.int64)
        self.id_stops = at + np.cumsum(text)
        at += int(text.sum())
        self.offsets = np.frombuffer(content, "<u8", self.n_blocks + 1, at).astype(np.int64)

    def ids(self) -> list[str | None]:
        return [None if size == NULL else self.content[stop - size : stop].decode() for size, stop in zip(self.id_sizes.tolist(), self.id_stops.tolist())]

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return unpack(self.content[self.offsets[k] : self.offsets[k] + (n * self.bits + 7) // 8], n, self.bits)


def ids_at(content: bytes, start: int, stop: int) -> np.ndarray:
    """The ids at places start to stop (exclusive) of a shard; only the blocks that hold them are unpacked."""
    shard = Shard(content)
    start, stop = max(0, start), min(stop, shard.n_ids)
    if start >= stop:
        return np.zeros(0, dtype="<u4")
    first = start // shard.block_ids
    whole = np.concatenate([shard.block(k) for k in range(first, (stop - 1) // shard.block_ids + 1)])
    return whole[start - first * shard.block_ids : stop - first * shard.block_ids]


def _letters(word: str) -> bool:
    """Surely letters to any edition of Unicode."""
    return word.isalpha() and max(word) < "ɐ"


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable character: itself, or one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(printable))}


def _encoder(held: dict):
    """A function from a text to the bytes of its ids; what it has learnt stays in ``held``."""
    if "encode" in held:
        return held["encode"]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(held["json"])
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    level = tokenizer.pre_tokenizer
    plain = type(level).__name__ == "ByteLevel" and not level.add_prefix_space and level.use_regex and tokenizer.normalizer is None
    plain = plain and all(x.special for x in tokenizer.get_added_tokens_decoder().values())
    model, space, letters = tokenizer.model.tokenize, _byte_letters()[32], _byte_letters()
    spaced: dict[str, bytes] = {}  # of a piece with a space before it
    bare: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def clean(piece: str) -> bool:
        return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()

    def word(letters_: str, before: str) -> bytes:
        """Of a pre-token of letters, after a space or not."""
        written = letters_ if letters_.isascii() else "".join(map(letters.__getitem__, letters_.encode()))
        return struct.pack(f"<{len(t := model(before + written))}I", *[x.id for x in t])

    def learnt(piece: str, memo: dict[str, bytes], before: str) -> bytes:
        """Of a clean piece without spaces; ``before`` is the space before it, or nothing."""
        found = memo.get(piece)
        if found is not None:
            return found
        if _letters(piece):
            found = word(piece, before)
        elif _letters(stem := piece.rstrip(",.;:!?")):
            found = learnt(stem, memo, before) + learnt(piece[len(stem) :], bare, "")
        elif "\n" in piece and all(map(clean, parts := piece.split("\n"))):
            return learnt(parts[0], memo, before) + b"".join([line_feed + learnt(part, bare, "") for part in parts[1:]])
        else:
            found = whole(" " + piece if before else piece)
        memo[piece] = found
        return found

    line_feed = whole("\n")

    def encode(text: str) -> bytes:
        if not plain:
            return whole(text)
        if len(spaced) + len(bare) > MEMO:
            spaced.clear()
            bare.clear()
        pieces = text.split(" ")
        out = list(map(spaced.get, pieces))
        out[0] = None
        glued: set[int] = set()  # pieces without a sure border before them
        for i, found in enumerate(out):
            if found is None:
                piece = pieces[i]
                if piece.isalpha() or clean(piece):
                    out[i] = learnt(piece, spaced, space) if i else learnt(piece, bare, "")
                else:
                    glued |= {i, i + 1}
        if glued:
            end = -1
            for i in sorted(glued - {0, len(pieces)}):  # runs of them are encoded whole, with the piece before them
                if i >= end:
                    begin, end = i - 1, i + 1
                    while end in glued and end < len(pieces):
                        end += 1
                    out[begin] = whole((" " if begin else "") + " ".join(pieces[begin:end]))
                out[i] = b""
            if out[0] is None:
                out[0] = whole(pieces[0])
        return b"".join(out)

    held["encode"] = encode
    return encode


def _shards(shared, end_id: int, bits: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(shared.value), struct.pack("<I", end_id)
        ids, counts, held, waiting, offsets, n_ids = [], [], [], 0, [0], 0

        def block(n: int) -> pa.RecordBatch:
            nonlocal held, waiting
            raw = b"".join(held)
            held, waiting = [raw[4 * n :]], waiting - n
            packed = pack(np.frombuffer(raw, "<u4", n), bits)
            offsets.append(offsets[-1] + len(packed) + 1)
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["value"])

        for batch in batches:
            for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                raw = encode(text) + end
                ids.append(key)
                counts.append(len(raw) // 4)
                held.append(raw)
                waiting += counts[-1]
                n_ids += counts[-1]
                while waiting >= block_ids:
                    yield block(block_ids)
        if not ids:
            return
        if waiting:
            yield block(waiting)
        names = [None if key is None else key.encode() for key in ids]
        sizes = np.array([NULL if x is None else len(x) for x in names], dtype="<u4")
        tail = sizes.tobytes() + np.array(counts, dtype="<u8").tobytes() + b"".join(x for x in names if x) + np.array(offsets, dtype="<u8").tobytes()
        tail += struct.pack(TRAILER, offsets[-1], len(ids), n_ids, len(offsets) - 1, bits, block_ids, MAGIC)
        yield pa.RecordBatch.from_arrays([pa.array([tail], pa.binary())], ["value"])

    return run


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, block_ids: int = BLOCK_IDS, shard_chars: int = SHARD_CHARS) -> None:
    """Encode documents and write their shards to a new folder."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast({"json": f.read()})
    size = max(Tokenizer.from_str(shared.value["json"]).get_vocab_size(), end_id + 1)
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, math.ceil(chars / shard_chars))
    rows = docs.select(F.col(id_col).alias("key"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_last(), F.col("hash"), F.col("row")]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select(F.col("key").cast("string").alias("id"), "text")
    packed = dealt.mapInArrow(_shards(shared, end_id, max(1, (size - 1).bit_length()), block_ids), "value binary")
    packed.select(F.col("value").cast("string")).write.option("compression", "none").option("lineSep", "\n").option("maxRecordsPerFile", 0).text(path)


READ = "shard long, nth long, id string, at long, n_tokens long, ids binary"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, content in zip(batch["shard"].to_pylist(), batch["content"]):
            content = content.as_py()
            if not content:
                continue  # a writer without documents
            shard = Shard(content)
            stops = np.cumsum(shard.counts)
            names, first, held, base = shard.ids(), 0, [], 0
            # documents that end in a block go out with it
            for k in range(shard.n_blocks):
                held.append(shard.block(k).tobytes())
                last = int(np.searchsorted(stops, min(shard.n_ids, (k + 1) * shard.block_ids), side="right"))
                if last > first:
                    raw = b"".join(held)
                    at, n = (stops - shard.counts)[first:last], shard.counts[first:last]
                    cuts = [raw[4 * (a - base) : 4 * (a - base + c)] for a, c in zip(at.tolist(), n.tolist())]
                    held, base = [raw[4 * (int(stops[last - 1]) - base) :]], int(stops[last - 1])
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([number] * len(cuts), pa.int64()), "nth": pa.array(range(first, last), pa.int64()), "id": pa.array(names[first:last], pa.string()), "at": pa.array(at), "n_tokens": pa.array(n), "ids": pa.array(cuts, pa.binary())})
                    first = last
            if first != shard.n_docs:
                raise ValueError("a shard holds fewer ids than its documents")


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """A row a document: shard, nth (its place among the shard's documents), id (as text), at (place of its first id in
    the shard), n_tokens, ids (4 bytes each, little-endian, the end id included)."""
    files = spark.read.format("binaryFile").load(path)
    number = F.regexp_extract("path", r".*/part-(\d+)", 1).cast("long")
    return files.select(number.alias("shard"), "content").mapInArrow(_documents, READ)


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before, to rows of (shard, at, n_tokens, ...) of a written table."""
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # a row a shard
    firsts = materialise(totals.select(F.col("shard").alias("__shard"), (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("__first")), "packed-shards")
    return rows.join(beside(firsts), F.col("shard") == F.col("__shard")).withColumn("start", F.col("__first") + F.col("at")).drop("__shard", "__first")


def op13_packed_tokens(spark, sf_dir):
    docs, path = documents(spark, sf_dir), new_path(spark, "packed")
    write_packed(docs, path)
    found = materialise(read_packed(spark, path).select("shard", F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "at", "n_tokens", F.crc32("ids").alias("ids_crc32")), "packed-read")
    return numbered(found).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op13_packed_tokens": op13_packed_tokens}
SQL: dict[str, str] = {}
