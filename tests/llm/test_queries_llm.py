"""The registered corpus queries over whole tables: against their SQL, or against brute force where SQL has none."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from brute_force import PLAIN, brute_simhash, near_brute, plain_ok
from orrery.llm import byte_bpe, license_scan, queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def docs(data):
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{data}/documents.parquet'").fetchall()


def rows(name, spark, data):
    return QUERIES[name](spark, data).collect()


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(name, spark, data):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = QUERIES[name](spark, data)
    found = con.sql(SQL[name])
    assert sorted(found.columns) == sorted(df.columns)
    text = lambda r: tuple(str(v) for v in r)
    assert sorted(map(text, df.collect())) == sorted(map(text, found.project(", ".join(df.columns)).fetchall()))


def test_licenses(spark, data, docs):
    got = {r.doc_id: r for r in rows("op1_license_scan", spark, data)}
    assert len(got) == len(docs)
    for k, text, _ in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_urls(spark, data):
    got = {r.page_id: r for r in rows("op3_url_filter", spark, data)}
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
    for k, url in duckdb.sql(f"SELECT page_id, url FROM '{data}/pages.parquet'").fetchall():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, max(fit)[1] if fit else None)
        assert r.verdict == (max(fit)[2] if fit else r.verdict) and r.verdict in ("allow", "block")


def test_near_copies(spark, data, docs):
    got = {r.doc_id: r for r in rows("op4_simhash", spark, data)}
    prints = {k: brute_simhash(t) for k, t, _ in docs}
    ids = sorted(prints)
    a = np.array([prints[k] for k in ids], dtype=np.uint64)
    near, label = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3, np.arange(len(ids))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    assert {k: got[k].component_id for k in ids} == {k: ids[label[i]] for i, k in enumerate(ids)}
    assert all(got[k].fingerprint == format(prints[k], "016x") for k in ids)


def test_mix(spark, data, docs):
    got = rows("op5_mixing", spark, data)
    sizes = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t, _ in docs}
    total, source = collections.Counter(), {k: s for k, _, s in docs}
    for k, n in sizes.items():
        total[source[k]] += n
    order = sorted(total, key=lambda s: (s is None, s))
    weight, want = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}
    capped = set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        want = {s: 2 * total[s] if s in capped else left * weight[s] / share for s in order}
        over = {s for s in order if s not in capped and want[s] > 2 * total[s]}
        if not over:
            break
        capped |= over
    taken = collections.Counter()
    for r in got:
        assert (r.size, r.source_size) == (sizes[r.doc_id], total[source[r.doc_id]]) and r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 0.2 * max(n for k, n in sizes.items() if source[k] == s) for s in order)
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows("op5_mixing", spark, data)))


def test_personal_data(spark, data, docs):
    got = {r.doc_id: r for r in rows("op6_pii", spark, data)}
    for k, text, _ in docs:
        want = [f"{kind}:{m.start()}:{m.end()}" for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if plain_ok(kind, m.group())]
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(got[k].spans.split(",")) | {""}


def test_quality(spark, data, docs):
    got = {r.doc_id: r for r in rows("op8_quality_rules", spark, data)}
    for k, text, _ in docs:
        words, text = re.findall(r"[^\x20\x09-\x0D]+", text or ""), text or ""
        count, cover, seen, again = collections.Counter(zip(words, words[1:], words[2:])), set(), set(), 0
        for i in range(len(words) - 2):
            if count[tuple(words[i : i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(cover))
        assert r.base_failed == (len(words) < 50 or 100 * len(cover) > 50 * len(words)) and not (r.kept and r.base_failed)
    marks = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{data}/labels.parquet'").fetchall())
    judged = [(marks[k], r.kept) for k, r in got.items() if k in marks and not r.base_failed]
    assert sum(kept for good, kept in judged if good) >= 0.95 * sum(good for good, _ in judged)
    assert sum(not kept for good, kept in judged if not good) >= 0.5 * sum(not good for good, _ in judged)


def test_tokens(spark, data, docs):
    import tiktoken

    path, pattern = byte_bpe.default_vocabulary()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in rows("op10_byte_bpe", spark, data)}
    for k, text, _ in docs:
        ids = own.encode_ordinary(text or "")
        assert tuple(got[k])[1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_pipeline_against_its_parts(spark, data):
    """run() equals its stages applied in turn, each held against what its operator's query says."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = {r.doc_id for r in rows("op8_quality_rules", spark, data) if r.kept}
    first = corpus_pipeline.quality_rules(spark, docs, data)
    assert {r.doc_id for r in first.select("doc_id").collect()} == kept
    table = spark.createDataFrame(first.collect(), first.schema)
    second = corpus_pipeline.line_chunks(spark, table, data)
    cleaned = {r.doc_id: r.text for r in second.collect()}
    assert set(cleaned) == kept and all(r.n_chars == len(r.text) for r in second.collect())
    table = spark.createDataFrame(second.collect(), second.schema)
    third = {r.doc_id for r in corpus_pipeline.near_copies(spark, table, data).collect()}
    assert third == near_brute(cleaned)  # five words, a similarity of 0.8 or more
    final = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in final} <= third and max(collections.Counter(r.doc_id for r in final).values()) <= 2
