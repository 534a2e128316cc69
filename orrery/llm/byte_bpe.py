"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

Encoding: tasks split texts into pre-tokens and keep, for each block of documents, the list of distinct words and every
pre-token's position as an index into that list. Only the distinct words of blocks are exploded: they are dealt out by
a hash of the word, so that each distinct word of the corpus meets its equals in one task and is encoded once; the ids
go back to the blocks in the order the words came, and each block is reassembled by position. Words and positions go
through one exchange, which both uses read (Spark reuses it, so texts are split once). What is shuffled is packed (a
row per block and bucket of words, zstd) and holds a word once a block at most, so no word is hot; a block is bounded by
``block_chars`` (or one document, if that is longer). Decoding joins the token-byte table (one row an id of
the vocabulary file, which bounds its size) inside each task.

A task remembers the ids of ``MEMO`` words. Beyond that it forgets them, and a word that comes again is encoded again: the
results are the same, and a vocabulary of distinct words that outgrows memory costs time only.

Nulls: a null text counts as empty; an empty text has no ids and decodes to no bytes. Null ids, repeated rows and rows
that share an id each give a row of their own. Ids of any type that a cast to string and back keeps (whole numbers of any
size, strings) come out as they went in. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import documents

BLOCK_CHARS = 4_000_000
#: Tasks of the word shuffle and of reassembly get about so many characters of text each.
TASK_CHARS = 12_000_000
#: Longer pieces are merged with a heap here, as tiktoken's loop takes the square of a piece's length.
LONG_PIECE = 500


def default_vocabulary() -> tuple[str, str]:
    """The path of the ranks file and the pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Lowest rank first, leftmost among equals, over a linked list of parts."""
    n = len(piece)
    end, before, after = [i + 1 for i in range(n)], list(range(-1, n - 1)), [*range(1, n), -1]
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while 0 <= i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class _Index(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _planes(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane by byte plane: high bytes are mostly equal, so they pack well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


#: A row a block (bucket null, dealt to the block's own place) and a row a block and bucket of words (dealt by bucket).
BLOCKS = "place long, block long, bucket int, words binary, ids array<string>, sizes array<int>, seq binary"


def _blocks(pattern: str, block_chars: int, buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex
        import zstandard

        find, pack = regex.compile(pattern).findall, zstandard.ZstdCompressor(level=3).compress
        part, number = TaskContext.get().partitionId(), 0
        index, ids, seqs, chars = _Index(), [], [], 0

        def emit() -> pd.DataFrame:
            block = part << 32 | number
            whole = np.concatenate([np.zeros(0, dtype=np.int64), *seqs])
            words = list(index)
            dealt: list[list[int]] = [[] for _ in range(buckets)]
            for at, word in enumerate(words):
                dealt[zlib.crc32(word.encode()) % buckets].append(at)
            # positions hold the rank of a word by frequency, which packs best; the frequencies, in the order of the
            # buckets, lead back from a rank to the word
            often = np.bincount(whole, minlength=len(words))
            order, rows = [], []
            for bucket, own in enumerate(dealt):
                if own:
                    own.sort(key=lambda at: words[at])
                    order += own
                    raw = [words[at].encode() for at in own]
                    rows.append((-1 - bucket, block, bucket, pack(np.array(list(map(len, raw)), dtype="<u4").tobytes() + b"".join(raw)) + len(raw).to_bytes(4, "little"), None, None, None))
            often = often[order] if order else often
            place = np.empty(len(words), dtype=np.int64)
            place[order] = np.argsort(np.argsort(-often, kind="stable"), kind="stable")
            seq = pack(_planes(place[whole]))
            rows.append((block, block, None, None, ids, [len(s) for s in seqs], len(seq).to_bytes(8, "little") + seq + pack(_planes(often))))
            return pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")]).astype({"bucket": "Int32"})

        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                text = text or ""
                seqs.append(np.fromiter(map(index.__getitem__, find(text)), dtype=np.int64))
                ids.append(key)
                chars += len(text)
                if chars >= block_chars:
                    yield emit()
                    index, ids, seqs, chars, number = _Index(), [], [], 0, number + 1
        if ids:
            yield emit()

    return run


#: Words that a task remembers the ids of; beyond, it forgets them all and encodes a word again when it comes again.
MEMO = 500_000


def _encode_words(ranks):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
        table, memo = ranks.value, {}
        # a word is a pre-token already: this pattern takes it whole
        encode_word = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=table, special_tokens={}).encode_ordinary
        for batch in batches:
            out = []
            batch = batch[batch["bucket"].notna()]
            for packed in batch["words"]:
                n, raw = int.from_bytes(packed[-4:], "little"), unpack(packed[:-4])
                stops = np.cumsum(np.frombuffer(raw[: 4 * n], dtype="<u4"), dtype=np.int64) + 4 * n
                if len(memo) > MEMO:
                    memo.clear()
                found, a = [], 4 * n
                for b in stops.tolist():
                    word = raw[a:b]
                    a = b
                    ids = memo.get(word)
                    if ids is None:
                        ids = memo[word] = encode_word(word.decode()) if len(word) <= LONG_PIECE else merge_long(word, table)
                    found.append(ids)
                counts = np.array(list(map(len, found)), dtype="<u4")
                out.append(pack(_planes(np.concatenate([counts, np.array([i for ids in found for i in ids], dtype="<u4")]))) + n.to_bytes(4, "little"))
            yield pd.DataFrame({"home": batch["block"], "bucket": batch["bucket"], "coded": out})

    return run


def _reassemble(words: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    import zstandard

    blocks = blocks[blocks["bucket"].isna()]

    unpack = zstandard.ZstdDecompressor().decompress
    counts, tokens = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype="<u4")]
    for packed in words.sort_values("bucket")["coded"]:
        n, values = int.from_bytes(packed[-4:], "little"), _unplanes(unpack(packed[:-4]))
        counts.append(values[:n])
        tokens.append(values[n:])
    count = np.concatenate(counts).astype(np.int64)
    start = np.cumsum(count) - count
    flat = np.concatenate(tokens).astype(np.int32)
    ids, out = [], []
    for row in blocks.itertuples():
        cut = 8 + int.from_bytes(row.seq[:8], "little")
        ranked = np.argsort(-_unplanes(unpack(row.seq[cut:])).astype(np.int64), kind="stable")
        whole = ranked[_unplanes(unpack(row.seq[8:cut]))]
        stops = np.cumsum(row.sizes, dtype=np.int64)
        for key, stop, size in zip(row.ids, stops, row.sizes):
            s = whole[stop - size : stop]
            n = count[s]
            ids.append(key)
            out.append(flat[np.repeat(start[s] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if size else flat[:0])
    return pd.DataFrame({"id": pd.Series(ids, dtype=object), "tokens": pd.Series(out, dtype=object)})


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pattern: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: its id and ``tokens``, an array of token ids."""
    spark = docs.sparkSession
    vocabulary, pattern = vocabulary or default_vocabulary()[0], pattern or default_vocabulary()[1]
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))
    # tasks by the input's size, so that what one reads doesn't grow with it; ids pass through Python as text
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(chars / TASK_CHARS))
    buckets = 2 * tasks
    blocks = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(_blocks(pattern, block_chars, buckets), BLOCKS)
    # one exchange serves both uses: words meet by bucket, and a block's positions wait where its ids will come
    dealt = blocks.repartition(tasks, "place")
    coded = dealt.mapInPandas(_encode_words(ranks), "home long, bucket int, coded binary")
    found = coded.groupBy("home").cogroup(dealt.groupBy("place")).applyInPandas(_reassemble, "id string, tokens array<int>")
    return found.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "tokens")


def token_bytes(spark: SparkSession, vocabulary: str | None = None) -> list[bytes]:
    """The bytes of each token, by id."""
    ranks = load_ranks(vocabulary or default_vocabulary()[0])
    table = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    return table


def decode(encoded: DataFrame, tokens_col: str = "tokens", vocabulary: str | None = None) -> DataFrame:
    """Add ``decoded``: the bytes of the tokens, in order."""
    table = encoded.sparkSession.sparkContext.broadcast(token_bytes(encoded.sparkSession, vocabulary))

    @F.pandas_udf("binary")
    def joined(tokens: pd.Series) -> pd.Series:
        find = table.value.__getitem__
        return pd.Series([b"".join(map(find, t.tolist())) if t is not None else b"" for t in tokens], dtype=object)

    return encoded.withColumn("decoded", joined(tokens_col))


def digests(encoded: DataFrame) -> DataFrame:
    decoded = decode(encoded)
    return decoded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_byte_bpe(spark, sf_dir):
    return digests(encode(documents(spark, sf_dir)))


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
SQL: dict[str, str] = {}
