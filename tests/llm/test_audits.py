"""Divergence audit, filter audit and packed token files: against brute force, on edge cases and where tasks meet."""

import collections
import glob
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import divergence_audit, filter_audit, packed_tokens
from orrery.llm.common import materialise, new_path, space_cuts

SCHEMA = "doc_id long, text string, lang string, source string, n string, term string, mask string, task string, key string, row string"
COPY = "the same words in many rows of the table"
ROWS = (
    [(k, f"alpha Beta gamma{'s' * (k % 3)} xé{k % 4} Delta", "en", f"s{k % 4}", *"xxxxxx") for k in range(60)]
    + [(100 + k, COPY, "en" if k % 2 else None, "hot", *"xxxxxx") for k in range(90)]
    + [(100, COPY, "en", "hot", *"xxxxxx"), (100, COPY, "de", None, *"xxxxxx"), (None, COPY, "de", "x", *"xxxxxx"), (None, COPY, "de", "x", *"xxxxxx")]
    + [(300, None, "fr", "a", *"xxxxxx"), (301, "", "fr", "b", *"xxxxxx"), (302, None, None, None, *"xxxxxx"), (303, " \t\n", "en", "s0", *"xxxxxx")]
    + [(400, "WORD " * 70_000 + "end", "en", "s1", *"xxxxxx"), (None, "n1", "en", "s2", *"xxxxxx"), (None, "n1", "en", "s2", *"xxxxxx"), (500, "# five hundred", "en", "s2", *"xxxxxx")]
    + [(600 + k, " ".join(f"w{j}" for j in range(90 + k)), "es", "s3", *"xxxxxx") for k in range(15)]
)


@pytest.fixture(scope="module")
def docs(spark):
    return materialise(spark.createDataFrame(ROWS, SCHEMA).repartition(5), "audit-docs")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, None if k % 5 == 0 else int(k % 3 == 0)) for k in range(0, 620, 2)] + [(1, 1, 1), (1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def brute_divergence(rows, least=10, top=10):
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n.update((lang, source, w) for w in words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept, sources = sorted(w for (k, w), c in docs.items() if k == lang and c >= least), sorted(s for k, s in groups if k == lang)
        total = {s: sum(n[lang, s, w] for w in kept) for s in sources}
        of_lang = {w: sum(n[lang, s, w] for s in sources) for w in kept}
        p = {s: [1 + 10**9 * (n[lang, s, w] + 2) // (total[s] + 2 * len(kept)) for w in kept] for s in sources}
        q = [1 + 10**9 * (of_lang[w] + 2) // (sum(of_lang.values()) + 2 * len(kept)) for w in kept]
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(map(f, p[s], p[o])), o.encode()) for o in sources if o != s]
            terms = [(-f(x, y), w.encode()) for w, x, y in zip(kept, p[s], q) if n[lang, s, w] and x > y]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def test_divergence(docs, spark):
    got = sorted(map(tuple, divergence_audit.divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect()))
    want = brute_divergence([r[1:4] for r in ROWS])
    assert got == want and {r[2] for r in got} == {"pair", "term"} and any(r[0] == "fr" and r[4] == 0 for r in got)
    assert divergence_audit.divergence(docs.limit(0)).count() == 0


def test_shares_stay_exact(spark):
    row = spark.range(1).select(F.lit(10**16).alias("c"), F.lit(10**17).alias("n"), F.lit(10**6).alias("v"))
    p = row.select(divergence_audit.share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert p == 1 + 10**9 * (10**16 + 2) // (10**17 + 2 * 10**6)
    assert spark.range(1).select(divergence_audit.gap(F.lit(10**9).cast("long"), F.lit(3).cast("long"))).first()[0] == (10**9 - 3) ** 2 // (10**9 + 3)


def test_space_cuts():
    raw = b" ".join(b"w%d" % k for k in range(5000)) + b" " + b"x" * 3000 + b"  end"
    pieces = list(space_cuts(raw, 64))
    assert b"".join(pieces) == raw and [w for p in pieces for w in p.split()] == raw.split() and len(pieces) > 300
    assert list(space_cuts(b"")) == [b""]


def brute_masks(rows):
    least, out = {}, []
    for key, text, *_ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        first = least.get(text)
        failed = (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), first is not None and (key is None or key > first))
        out.append((key, lang or "", sum(x << k for k, x in enumerate(failed))))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("chars", [10**9, 40])
def test_masks(docs, chars):
    """Also with so many tasks that a text's copies run over several of them."""
    got = filter_audit.failure_masks(docs, task_chars=chars).collect()
    text = lambda rows: sorted(map(str, rows))
    assert text(map(tuple, got)) == text(brute_masks(ROWS))


def test_masks_where_fingerprints_collide(docs):
    got = filter_audit.failure_masks(docs, task_chars=4000, fingerprint=lambda t: F.length(t).cast("long") % 2).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_masks(ROWS)))


def test_orders(docs, labels):
    counted = filter_audit.counters(filter_audit.failure_masks(docs), labels)
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.orders_report(counted).collect()}
    good, toxic = collections.Counter(), collections.Counter()
    for r in labels.collect():
        good[r.doc_id] |= r.quality == 1
        toxic[r.doc_id] |= r.toxic == 1
    rows = [(part, mask, key is not None and good[key], key is not None and toxic[key]) for key, part, mask in brute_masks(ROWS)]
    parts, orders = {r[0] for r in rows}, list(itertools.permutations("ABCDE"))
    assert len(got) == len(parts) * 600 and "" in parts
    shapley = collections.Counter()
    for part, mask, *_ in rows:
        for order in orders:
            shapley[part, next((c for c in order if mask >> "ABCDE".index(c) & 1), None)] += 1
    for part in parts:
        own = [r for r in rows if r[0] == part]
        for order in orders[::7]:
            left = own
            for step, c in enumerate(order, 1):
                fails = lambda r: r[1] >> "ABCDE".index(c) & 1  # noqa: B023, E731
                out, r = [x for x in left if fails(x)], got[part, "".join(order), step]
                want = (len(left) - len(out), len(out), sum(map(bool, map(fails, own))) - len(out), sum(x[1] == 1 << "ABCDE".index(c) for x in own), sum(x[2] for x in out), sum(x[3] for x in out), shapley[part, c])
                assert tuple(r)[3:] == want
                left = [x for x in left if not fails(x)]
    assert filter_audit.orders_report(filter_audit.counters(filter_audit.failure_masks(docs.limit(0)), labels)).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 24, 31, 32])
def test_packing(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint32)
        raw = packed_tokens.pack(ids, bits)
        spelt = "".join(format(int(i), f"0{bits}b")[::-1] for i in ids)  # low bits first
        assert raw == bytes(int(spelt[k : k + 8][::-1], 2) for k in range(0, len(spelt), 8))
        assert len(raw) == (n * bits + 7) // 8 and (packed_tokens.unpack(raw, n, bits) == ids).all()
    if bits < 32:
        with pytest.raises(ValueError):
            packed_tokens.pack(np.array([1 << bits], dtype=np.uint32), bits)


def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packed_tokens.default_tokenizer())
    found.encode_special_tokens = True
    return found


def test_encoding_by_pieces():
    whole = tokenizer()
    with open(packed_tokens.default_tokenizer(), encoding="utf-8") as f:
        encode = packed_tokens._encoder({"json": f.read()})
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "a", "word", "Word,", "it's", "we'll.", "'s", "...", "?!", "12", "3.5", "été", "中文", "é", "\U0001f600", "<|endoftext|>", "ǅ", "º", "x_y", "١", "​", "-", "end."]
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(12)))
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("chars, block", [(10**9, 1 << 16), (300, 8), (5000, 64)])
def test_packed_files(docs, spark, tmp_path, chars, block):
    path, whole = new_path(spark, "packed-test"), tokenizer()
    packed_tokens.write_packed(docs, path, end_id=0, block_ids=block, shard_chars=chars)
    got = packed_tokens.numbered(materialise(packed_tokens.read_packed(spark, path), "packed-test-read")).orderBy("start").collect()
    want = [(r[0], whole.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in ROWS]
    read = [(None if r.id is None else int(r.id), np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert sorted(map(str, read)) == sorted(map(str, want)) and [r.n_tokens for r in got] == [len(x) for _, x in read]
    assert [r[0] is None for r in read] == sorted(r[0] is None for r in read) and [k for k, _ in read if k is not None] == sorted(r[0] for r in ROWS if r[0] is not None)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    # any slice of a shard, without the rest
    shards = sorted(x for x in glob.glob(f"{path.removeprefix('file:')}/part-*"))
    for name in shards[:4]:
        with open(name, "rb") as f:
            content = f.read()
        if content:
            shard = packed_tokens.Shard(content)
            flat = np.concatenate([shard.block(k) for k in range(shard.n_blocks)])
            assert shard.bits == 16 and len(flat) == shard.n_ids
            for a, b in ((0, 1), (5, 70), (shard.n_ids - 3, shard.n_ids + 9), (9, 9)):
                assert (packed_tokens.ids_at(content, a, b) == flat[max(0, a) : b]).all()
    with pytest.raises(ValueError):
        packed_tokens.Shard(content[:-2] if content else b"x")


def test_packed_files_of_nothing(docs, spark):
    path = new_path(spark, "packed-test")
    packed_tokens.write_packed(docs.limit(0), path)
    assert packed_tokens.read_packed(spark, path).count() == 0


def test_packed_query(spark, data):
    got = {r.doc_id: r for r in packed_tokens.op13_packed_tokens(spark, data).collect()}
    whole, start = tokenizer(), 0
    for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
