"""The pipeline's near-copies stage against brute-force Jaccard similarity of five-word shingles."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute_force import near_brute
from orrery.llm import near_copies as near
from orrery.llm import simhash


def made() -> dict:
    """Texts with substituted words, chains of copies, a shared passage, short and empty texts."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(5000)}"
    shared, out = [word() for _ in range(60)], []
    for _ in range(20):
        base = [word() for _ in range(rng.randrange(100, 300))] + shared
        out.append(base)
        for n in (1, 2, 4, 6, 9):
            copy = list(base)
            for at in rng.sample(range(len(copy)), n):
                copy[at] = word()
            out.append(copy)
            base = copy if n == 2 else base
    out += [[], [], ["one"], ["One"], ["one", "two"], shared[:5], shared[:6], shared]
    rng.shuffle(out)
    return {i: " ".join(w) for i, w in enumerate(out)} | {len(out): None}


@pytest.mark.parametrize("source", ["made", "table"])
def test_stage_against_brute_force(spark, data, source):
    texts = made() if source == "made" else dict(duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall())
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, source string").repartition(5)
    got = corpus_pipeline.near_copies(spark, df, data)
    assert got.columns == df.columns
    kept = [r.doc_id for r in got.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == near_brute(texts)


def test_small_sets_far_apart_in_bits(spark, data):
    """Pairs of 4 and 5 shingles in common order, of similarity 0.8, whose fingerprints lie beyond the bits compared."""
    rng, texts = random.Random(11), {}
    while len(texts) < 8:
        words = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        a, b = near.shingles(" ".join(words)), near.shingles(" ".join(words[:8]))
        bits = lambda s: (simhash.majority(s), simhash.majority(near._again(s)))
        if sum((x ^ y).bit_count() for x, y in zip(bits(a), bits(b))) > near.WIDE:
            texts[len(texts)] = " ".join(words)
            texts[len(texts)] = " ".join(words[:8])
    texts |= {100 + k: " ".join(f"x{rng.randrange(10**6)}" for _ in range(9)) for k in range(30)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, df, data).collect()} == near_brute(texts) == {0, 2, 4, 6, *range(100, 130)}


def test_empty(spark, data):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert corpus_pipeline.near_copies(spark, df, data).collect() == []


def test_stages_bound_the_texts_that_a_worker_holds(spark):
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")

    @F.pandas_udf("long")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    docs = spark.range(2_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text")).coalesce(1)
    assert corpus_pipeline.near_copies(spark, docs, "").count() == 2_500
    assert docs.select(F.max(rows("text"))).first()[0] <= 1_000
