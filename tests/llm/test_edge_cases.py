"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from brute_force import PLAIN, brute_simhash, plain_ok
from orrery.llm import byte_bpe, exact_dedup, license_scan, line_dedup, mixing, near_copies, pii, quality, simhash, url_filter, warc
from orrery.llm.common import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, kept string"
LONG = " ".join(f"word{i % 997} tail{i % 13}" for i in range(60_000))
PROSE = "One plain line of words that goes on for a while.\nAnother line, with other words, that ends here.\n" * 3
ROWS = [
    (1, "Hello  world\tagain", "en", "a", 18, "x", "x", "x"),
    (2, "Hello world again", "en", "a", 17, "x", "x", "x"),
    (2, "Hello world again", "en", "a", 17, "x", "x", "x"),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "x", "x", "x"),
    (None, "Hello world again", None, None, 17, "x", "x", "x"),
    (None, None, None, None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG), "x", "x", "x"),
    (6, "é" * 5000 + "\x00\x1c ok", "en", "c", 5005, "x", "x", "x"),
    (7, PROSE, "en", "c", len(PROSE), "x", "x", "x"),
    (8, "7" * 20_000 + " a@" + "b." * 5000 + "c", "en", "c", 1, "x", "x", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows, key="doc_id"):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_exact_dedup(docs, none):
    rows = exact_dedup.exact_dedup(docs).collect()
    got = by_id(rows)
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in ROWS})
    assert got[1][0].kept and got[1][0].group_size == 4 and [r.keep_id for r in got[2]] == [1, 1]
    assert got[3][0].kept and got[4][0].keep_id == 3
    assert bytes(got[4][0].digest).hex() == hashlib.sha256(b"").hexdigest()
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_with_a_filter_that_is_full(docs):
    few = exact_dedup.exact_dedup(docs, max_bits=1)
    assert sorted(map(str, few.collect())) == sorted(map(str, exact_dedup.exact_dedup(docs).collect()))


def test_byte_bpe(docs, none, spark):
    import tiktoken

    path, pattern = byte_bpe.default_vocabulary()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    rows = byte_bpe.decode(byte_bpe.encode(docs, block_chars=40)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((r[0], (r[1] or ""), own.encode_ordinary(r[1] or "")) for r in ROWS if r[0] != 8), key=key)
    got = sorted(((r.doc_id, bytes(r.decoded).decode(), r.tokens) for r in rows if r.doc_id != 8), key=key)
    assert got == want and len(rows) == len(ROWS)
    assert [bytes(r.decoded).decode() for r in rows if r.doc_id == 8] == [ROWS[-1][1]]
    assert byte_bpe.encode(none).count() == 0
    ranks, rng = byte_bpe.load_ranks(path), random.Random(3)
    for n in (1, 2, 9, 700):
        for letters in (b"a", b"the ", bytes(range(256))):
            piece = bytes(rng.choice(letters) for _ in range(n))
            assert byte_bpe.merge_long(piece, ranks) == own._encode_single_piece(piece)


def test_pii(docs, none, spark):
    got = by_id(pii.find_pii(docs).collect())
    assert got[3][0].spans == [] and got[8][0].spans[0].kind == "email" and got[8][0].spans[0].start == 20_001
    assert got[8][0].n_chars == 1 and pii.find_pii(none).count() == 0
    texts = {
        1: "é mail a.b@c.de, then x@y.z+q@r.st and 10.0.0.255 not 10.0.0.256 1.2.3.4.5.6.7.8",
        2: "card 4111 1111 1111 1111 or 4111-1111-1111-1112; +1 (743) 555-3824) +49 30",
        3: "My bank: IBAN GB82 WEST 1234 5698 7654 32, GB83 WEST 1234 5698 7654 32",
        4: "social security 123-45-6789 and far away from any of the words that would tell us so: 123-45-6788",
    }
    found = {k: [(s.kind, s.value) for s in r[0].spans] for k, r in by_id(pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()).items()}
    assert found[1] == [("email", "a.b@c.de"), ("email", "x@y.z"), ("email", "+q@r.st"), ("ip", "10.0.0.255"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8")]
    assert found[2] == [("card", "4111 1111 1111 1111"), ("phone", "+1 (743) 555-3824")]
    assert found[3] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert ("ssn", "123-45-6789") in found[4] and len(found[4]) == 1
    for k, t in texts.items():
        for s in pii.find_pii(spark.createDataFrame([(k, t)], "doc_id long, text string")).first().spans:
            assert t[s.start : s.end] == s.value


def test_pii_against_the_plain_patterns(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("aé@..+- 0123456789()%") for _ in range(rng.choice([20, 200])))) for i in range(300)]
    texts += [(1000 + i, " ".join(rng.choice(["4111111111111111", "1.2.3.4", "a@b.co", "+1 555 123 4567", "12", "-", "é"]) for _ in range(30))) for i in range(100)]
    got = by_id(pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    for k, t in texts:
        want = [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, t) if plain_ok(kind, m.group())]
        assert [(s.kind, s.start, s.end) for s in got[k][0].spans if s.kind in PLAIN] == want, t


def test_license_scan(docs, none, spark):
    got = by_id(license_scan.scan_licenses(docs).collect())
    assert got[3][0].license.n_words == 0 and got[3][0].license.first_word is None and got[3][0].license.score == 0
    assert got[1][0].license.n_words == 3 and license_scan.scan_licenses(none).count() == 0
    texts = [
        (1, "x Released under the MIT-License. mit license"),
        (2, "Licensd under the Apache Licence, Version 2.0"),
        (3, "Redistribution and use in sorce and binary forms, with or without modificaton, are permited"),
        (4, "licensed under nothing at all"),
        (5, "MIT License MIT License"),
    ]
    got = {r.doc_id: r.license for r in license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels, got[1].score) == (2, 4, 6, "mit", "mit", 1.0)
    assert got[2].base_labels == "" and got[2].labels == "apache" and got[2].spans[0].errors == 2 and (got[2].spans[0].first_word, got[2].spans[0].last_word) == (0, 7)
    assert got[3].labels == "bsd" and 0 < got[3].score < 1
    assert got[4].labels == "" and got[5].n_base == 2 and got[5].last_word == 2


def test_simhash(docs, none, spark):
    for r in ROWS:
        assert simhash.simhash(r[1]) == brute_simhash(r[1])
    rows = docs.select("doc_id", "text").withColumn("fp", simhash.fingerprint("text")).collect()
    assert all(r.fp % (1 << 64) == brute_simhash(r.text) for r in rows)
    kept = [r.doc_id for r in near_copies.drop_near_copies(docs).collect()]
    assert len(kept) == len(set(kept)) and 2 not in kept and None not in kept and 3 in kept and 4 not in kept
    assert near_copies.drop_near_copies(docs).columns == docs.columns
    assert near_copies.drop_near_copies(none).count() == 0


@pytest.mark.parametrize("tile", [8, 4096])
def test_simhash_links_against_all_pairs(spark, tile):
    from orrery.llm.components import connected_components

    rng, values = np.random.default_rng(0), set()
    for base in rng.integers(0, 2**63, 12, dtype=np.uint64):
        for _ in range(60):
            v = int(base)
            for _ in range(rng.integers(0, 5)):
                v ^= 1 << int(rng.integers(64))
            values.add(v)
    values = sorted(values | {0, (1 << 64) - 1})
    names = [v - (1 << 64) if v >> 63 else v for v in values]
    near = np.bitwise_count(np.array(values, dtype=np.uint64)[:, None] ^ np.array(values, dtype=np.uint64)[None, :]) <= 3
    label = list(range(len(values)))
    for _ in range(len(values)):
        new = [min(label[j] for j in np.flatnonzero(row)) for row in near]
        if new == label:
            break
        label = new
    want = {}
    for i, k in enumerate(label):
        want.setdefault(k, set()).add(names[i])
    got = {}
    for r in connected_components(simhash.near_links(spark.createDataFrame([(n,) for n in names], "fp long"), 3, tile)).collect():
        got.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_mixing(docs, none, spark):
    assert mixing.mix(none).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    rows = [(i, "w " * (1 + i * 7919 % 50), ["a", "b", "c", None][i % 4]) for i in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from pyspark.sql import functions as F

    plan = lambda df, block: mixing.plan_mix(mixing.units_of(df, "doc_id", "source", "text", F.monotonically_increasing_id()), block=block).toPandas()
    for block in (16, 4096):
        got = plan(table, block)
        assert len(got) == 800 and got["copies"].between(0, 2).all()
        for _, g in got.groupby("source", dropna=False):
            assert abs((g["copies"] * g["size"]).sum() - g["target"].iloc[0]) <= 0.01 * g["target"].iloc[0] + 25
        assert abs(got.groupby("source", dropna=False)["target"].first().sum() - 1.5 * got["size"].sum()) < 1e-6
    again = plan(table.repartition(7), 16)
    first = plan(table, 16)
    assert sorted(zip(first["id"], first["copies"])) == sorted(zip(again["id"], again["copies"]))


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    sizes, p = rng.integers(1, 900, 500).astype(float), np.full(500, 0.37)
    got = mixing.flight(sizes, p, rng)
    assert ((got > 0) & (got < 1)).sum() <= 2 and abs(got.sum() - p.sum()) < 1e-6 and abs((got * sizes).sum() - (p * sizes).sum()) < 1e-3


def test_line_dedup(docs, none, spark):
    assert line_dedup.dedup_lines(none).count() == 0
    got = by_id(line_dedup.dedup_lines(docs).collect())
    assert got[3][0].text is None and [r.text for r in got[2]] == ["Hello world again"] * 2 and got[5][0].text == LONG
    rng = random.Random(2)
    shared = [f"shared line {i} {rng.random()}" for i in range(40)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(rng.randrange(9))] + shared + [f"end {i}"])) for i in range(6)]
    out = {r.doc_id: r.text.split("\n") for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1].split("\n")
    for i in range(1, 6):
        assert [x for x in rows[i][1].split("\n") if x.startswith(("own", "end"))] == [x for x in out[i] if x.startswith(("own", "end"))]
        assert sum(x in shared for x in out[i]) < 12


def test_quality(docs, none, spark):
    assert quality.filter_quality(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    got = by_id(quality.label_quality(docs, None).collect())
    assert got[3][0].quality.n_words == 0 and got[3][0].quality.base_failed and got[2][0].quality.n_words == 3
    assert got[7][0].quality.n_dup_lines == 4
    good = [(i, f"Plain words of text number {i} go on here and there without end.\n" * 2 + " ".join(f"word{i}x{j}" for j in range(60)) + ".", 1) for i in range(60)]
    bad = [(100 + i, "\n".join(f"MENU{j} | {i} ### LINK!! | $$$ HOME{j}!!" for j in range(20)), 0) for i in range(60)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    kept = {r.doc_id for r in quality.filter_quality(table.select("doc_id", "text"), table.filter("doc_id % 2 = 0").select("doc_id", "quality")).collect()}
    assert kept == {g[0] for g in good}


def test_viterbi_against_all_labellings():
    from itertools import product

    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        scores, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        value = lambda y: sum(scores[i, k] for i, k in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        assert tuple(quality.viterbi(scores, move)) == max(product((0, 1), repeat=n), key=value)


def test_warc_round_trip(spark):
    magic = warc.MAGIC
    fake = magic + "WARC-Type: response\r\nContent-Length: 7\r\n\r\nfakebod\r\n\r\n"
    bodies = ["", "x" * 150, "x" * 150, "a" + fake + "tail", fake, fake * 3 + "é", magic + magic, "plain\r\n\r\n" + magic, None, "y" * 99, "y" * 99, magic * 300]
    table = spark.createDataFrame([(i if i != 9 else None, f"http://a/{i}\r\nX: y", b) for i, b in enumerate(bodies)], "page_id long, url string, payload string")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most, packed in (("128m", "none"), ("1000", "none"), ("1000", "gzip")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            path = new_path(spark, "warc-test")
            warc.write_warc(warc.with_revisits(table.coalesce(2)), path, packed, 7)
            got = sorted((re.search(r"urn:page:(\d*)", r.head).group(1), bytes(r.payload).decode()) for r in warc.read_warc(spark, path).collect())
            assert got == sorted(("" if i == 9 else str(i), "" if i == 2 else b or "") for i, b in enumerate(bodies))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    path = new_path(spark, "warc-test")
    warc.write_warc(warc.with_revisits(table.limit(0)), path)
    assert warc.read_warc(spark, path).count() == 0


def test_url_filter(spark):
    urls = [
        (1, None), (2, "no scheme/en/"), (3, "http://A.Example.COM/en/77?x=1"), (4, "https://example.com/en/6#top"), (5, "http://xexample.com/en/7"), (6, "http://b.example.net/de/80"),
        (7, "ftp://net/de/"), (8, "http://a.org/es/é"), (9, "http://a.org?q=/es/"), (10, "http://a.com://b.com/en/"), (10, "http://a.com://b.com/en/"), (None, "http://com/en/"),
    ]
    rows = url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string")).collect()
    got = by_id(rows, "page_id")
    assert len(rows) == len(urls)
    assert {k: (v[0].host, v[0].path, v[0].rule, v[0].verdict) for k, v in got.items()} == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.example.com", "/en/77", "example.com/en/7", "allow"), 4: ("example.com", "/en/6", "com/en/", "block"),
        5: ("xexample.com", "/en/7", "com/en/", "block"), 6: ("b.example.net", "/de/80", "example.net/de/8", "block"), 7: ("net", "/de/", "net/de/", "allow"), 8: ("a.org", "/es/é", "org/es/", "block"),
        9: ("a.org", "", None, "allow"), 10: ("a.com:", "//b.com/en/", None, "allow"), None: ("com", "/en/", "com/en/", "block"),
    }
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    many = [(i, f"http://spam.com/{'en' if i % 3 else 'fr'}/{i * 7919 % 9973}") for i in range(600)] + [(1000 + i, f"http://fine.io/a/{i}") for i in range(50)]
    judged = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(many, "page_id long, url string")).collect()}
    assert judged[0].rule is None and judged[0].template == "/+/*" and judged[0].verdict == "block" and judged[1003].verdict == "allow"


def test_pipeline_stages_keep_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near copies", "source mix", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert len(rows) == docs.count() > 0


def test_warc_chains_cross_tasks_and_survive_other_splits(spark):
    fake = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 7\r\n\r\nfakebod\r\n\r\n"
    table = spark.range(200).selectExpr("id AS page_id", "concat('http://a/', id) AS url", f"CASE WHEN id % 7 = 0 THEN concat('{'z' * 40}', '{fake}', id) ELSE concat(repeat('p', 50 + cast(id % 90 AS int)), id) END AS payload")
    path, kept = new_path(spark, "warc-test"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    warc.write_warc(warc.with_revisits(table.coalesce(1)), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        read = warc.read_warc(spark, path, stretch_bytes=1000)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # what is planned later may split otherwise
        got = {re.search(r"urn:page:(\d*)", r.head)[1]: bytes(r.payload).decode() for r in read.collect()}
        assert got == {str(r.page_id): r.payload for r in table.collect()}
        nodes = spark.createDataFrame([("f", 0, k, 10 * k, 10 * k + 10, 0, 1) for k in range(40)] + [("f", 0, 3, 35, 36, 1, 1)], "file string, split long, stretch int, at long, leaves long, first long, steps long")
        found, rounds = warc.reachable(nodes)
        assert sorted(r.entry for r in found.collect()) == [10 * k for k in range(40)] and rounds > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    short = new_path(spark, "warc-test")
    spark.read.text(path, wholetext=True).selectExpr("substring(value, 1, length(value) - 30) AS value").write.option("lineSep", "#").text(short)
    with pytest.raises(ValueError, match="end together"):
        warc.read_warc(spark, short)
    assert warc.read_warc(spark, short, damaged="keep").count() == 200


def test_numbers_tell_which_chains_come_by():
    rng = random.Random(1)
    for _ in range(50):
        at = sorted(rng.sample(range(100), 20))
        ahead = [rng.choice([b for b in at if b > a] + [200 + a % 3]) for a in at]
        first, last, leaves, steps = warc._numbers(at, ahead)
        succ = dict(zip(at, ahead))
        for i, e in enumerate(at):
            path = [e]
            while succ.get(path[-1]) in succ:
                path.append(succ[path[-1]])
            assert {a for k, a in enumerate(at) if first[k] <= first[i] <= last[k]} == set(path)
            assert (leaves[i], steps[i]) == (succ[path[-1]], len(path))


def test_pii_of_very_many_matches_in_one_text(spark):
    n = 60_000
    rows = pii.find_pii(spark.createDataFrame([(1, "é xy ".join(["a@b.co"] * n))], "doc_id long, text string"))
    found = rows.selectExpr("size(spans) AS n", f"transform(array(1, 244, 245, 246, {n - 1}), i -> spans[i].start) AS at").first()
    assert found.n == n and found["at"] == [11 * i for i in (1, 244, 245, 246, n - 1)]


def test_secrets_need_their_form_or_context(spark):
    rng, texts, planted = random.Random(9), [], {}
    for i in range(200):
        code = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        key = "AKIA" + "".join(rng.choice("0123456789ABCDEFGHIJ") for _ in range(16))
        kind = i % 4
        planted[i] = [f'some words then token = "{code}" and more', f"plainly {key} without any word for it", f"a revision {code} of the file", f"the long-hyphenated-compound-word-without-digits number {i}"][kind], kind < 2
        texts.append((i, planted[i][0]))
    got = {r.doc_id: [s for s in r.spans if s.kind == "secret"] for r in pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert all(bool(got[i]) == found for i, (_, found) in planted.items())
    assert all(t[s.start : s.end] == s.value and s.score >= 0.6 for i, t in texts for s in got[i])


def test_byte_bpe_keeps_ids_of_any_size_beside_nulls(spark):
    ids = [9007199254740993, None, 9007199254740995, -(2**63), None]
    rows = byte_bpe.encode(spark.createDataFrame([(k, f"text {i}") for i, k in enumerate(ids)], "doc_id long, text string").coalesce(1)).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, ids))
    named = byte_bpe.encode(spark.createDataFrame([("a", "x"), ("00", "y")], "doc_id string, text string")).collect()
    assert {r.doc_id for r in named} == {"a", "00"}


def test_mix_of_null_ids_does_not_follow_partitions(spark):
    rows = [(None, f"{'w ' * (i % 37)}{i}", "en", "ab"[i % 2], i, "x", "x", "x") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = lambda df: sorted((r.text, r.n_chars) for r in mixing.mix(df).collect())
    assert taken(docs.coalesce(1)) == taken(docs.repartition(7))


def test_quality_labels_lines_of_mixed_documents(spark):
    """Held-out documents that mix menus, shouting and prose: the line labels, and shares strictly between 0 and 1."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randrange(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rng.randrange(9, 30))).capitalize() + "."
    menu = lambda: " | ".join(word() for _ in range(rng.randrange(6, 20)))
    shout = lambda: " ".join(word().upper() + "!!" for _ in range(rng.randrange(6, 20)))
    made = lambda n, junk: [(prose(), 1) if rng.random() >= junk else (rng.choice([menu, shout])(), 0) for _ in range(n)]
    text = lambda lines: "\n".join(t for t, _ in lines)
    fitted = [(i, made(12, 0.03 if i % 2 else 0.8), i % 2) for i in range(300)]
    docs = spark.createDataFrame([(i, text(lines)) for i, lines, _ in fitted], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(i, y) for i, _, y in fitted], "doc_id long, quality int"))
    assert model[1][0, 1] - model[1][0, 0] > -8 and abs(model[1]).max() > 0.1
    hits = lines_seen = 0
    mixed = []
    for i in range(100):
        lines = [*made(6, 0.0), *made(8, 1.0), *made(6, 0.0)]
        stats, _, features, words = quality.measure([text(lines)])
        found = quality.viterbi(features @ model[0], model[1])
        hits, lines_seen = hits + sum(int(a == b) for a, (_, b) in zip(found, lines)), lines_seen + len(lines)
        mixed.append((i, text(lines)))
    assert hits >= 0.9 * lines_seen
    shares = [r.quality.content_share for r in quality.label_quality(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()]
    assert all(0 < s < 1 for s in shares)


def test_quality_fit_of_string_ids_and_repeated_ids(spark):
    rows = [(f"k{i % 40}", "A plain line of words that goes on for a while.\n" * 3 if i % 2 else "menu | of | words | here\n" * 3) for i in range(40)]
    docs = spark.createDataFrame([*rows, ("k1", "other text"), ("k1", None)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"k{i}", i % 2) for i in range(40)], "doc_id string, quality int")
    a, b = (quality.fit(d, labels) for d in (docs, docs.repartition(5)))
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
