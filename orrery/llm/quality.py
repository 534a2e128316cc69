"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Every line gets binary features (share of capitals and symbols, repeated words, length, ending). The field is trained
here, on the driver, by gradient ascent on at most ``max_labelled`` labelled documents (a documented bound; the sample
is the first by a hash of the id, whatever the table's size). A document's label narrows what its lines may be
(``allowed``), and the likelihood is that of all labellings it leaves open, so changes between content and boilerplate
inside documents are learnt as well. Viterbi decoding then labels the lines of every document; a document is kept if at
least ``least_share`` of its words stand in content lines and no base rule fails.

Nulls: a null text counts as empty (no words, so it fails the base rule of 50 words). Labels that are null are not
used; without labels of both kinds every line counts as content. Of labels that share an id the largest counts, and of
texts that do, that of the least hash. Ids are of any type that can be ordered. Ids, repeated rows and other columns pass through; an
empty table gives an empty result. Work is one pass inside map tasks, in groups of ``GROUP_CHARS`` characters or one text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from orrery.llm.common import documents

MAX_LABELLED = 3000
LEAST_SHARE = 0.5
GROUP_CHARS = 2_000_000
WINDOW = 64

_BLANK, _SYMBOL, _UPPER, _LOWER, _PIPE, _BANG, _STOP = (1 << i for i in range(7))


def _classes() -> np.ndarray:
    table = np.zeros(0x251, dtype=np.uint8)
    for c in range(0x250):
        s = chr(c)
        table[c] = (
            _BLANK * (c == 32 or 9 <= c <= 13) | _SYMBOL * (s in "#*$%&|<>") | _UPPER * s.isupper() | _LOWER * s.islower() | _PIPE * (s == "|") | _BANG * (s == "!") | _STOP * (s in ".?\"':;)»")
        )
    return table


CLASSES = _classes()
FEATURES = 15
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    again = np.fromiter((count[w] > 1 for w in windows), dtype=bool, count=len(windows))
    cover = np.zeros(len(words), dtype=bool)
    for i in range(3):
        cover[i : len(words) - 2 + i] |= again
    return int(cover.sum())


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the five statistics and its number of lines; per line: features and words."""
    whole = "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
    kinds = CLASSES[np.minimum(points, 0x250)]
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    per_line = lambda mask: np.add.reduceat(mask.astype(np.int32), starts)
    solid = (kinds & _BLANK) == 0
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    chars, words = per_line(solid), per_line(first)
    symbols, upper, lower, pipes, bangs = (per_line((kinds & k) > 0) for k in (_SYMBOL, _UPPER, _LOWER, _PIPE, _BANG))
    stop = (kinds[np.maximum(ends - 1, 0)] & _STOP) > 0
    stats, lines_of = np.zeros((len(texts), 5), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    distinct, again = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=bool)
    at = 0
    for i, text in enumerate(texts):
        lines, seen, tokens = text.split("\n"), set(), []
        for j, line in enumerate(lines, at):
            own = line.encode().split()
            tokens += own
            distinct[j] = len(set(own))
            if own:
                again[j] = line in seen
                seen.add(line)
        n = len(lines)
        stats[i] = len(tokens), chars[at : at + n].sum(), symbols[at : at + n].sum(), again[at : at + n].sum(), repeat_words(tokens)
        lines_of[i] = n
        at += n
    c, w, letters = np.maximum(chars, 1), np.maximum(words, 1), np.maximum(upper + lower, 1)
    caps, marks = upper / letters, symbols / c
    features = np.stack(
        [np.ones(len(starts)), caps > 0.6, (caps > 0.3) & (caps <= 0.6), marks > 0.05, (marks > 0.01) & (marks <= 0.05), bangs / c > 0.05, words <= 3, (words > 3) & (words < 8), words >= 40, stop,
         (words >= 8) & (distinct / w < 0.4), again, pipes / c > 0.02, chars / w > 12, chars / w < 2.5], axis=1,
    ).astype(np.float64)
    return stats, lines_of, features, words


def allowed(features: np.ndarray, lines_of: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per line, which labels (boilerplate, content) training lets it have.

    A document's label says what it is mostly, not what each line is. In good documents, lines without marks of
    boilerplate (shouting, symbols, pipes, repetition) are content and marked lines are open. In bad ones, marked lines
    are boilerplate, plain sentences content and the others open, unless no line is marked: then all are boilerplate."""
    f = features.astype(bool)
    marked = f[:, [1, 3, 5, 10, 11, 12]].any(axis=1)
    plain = f[:, 9] & ~f[:, [2, 4, 6]].any(axis=1) & ~marked
    out, stop = np.ones((len(f), 2), dtype=bool), 0
    for n, y in zip(lines_of.tolist(), labels.tolist()):
        a, stop = stop, stop + n
        own = marked[a:stop]
        if y:
            out[a:stop, 0] = own
        else:
            out[a:stop, 1] = ~own & own.any()
            out[a:stop, 0] = ~plain[a:stop] | ~own.any()
    return out


def _expected(e: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line the chances of both labels, and the expected counts of transitions, given scores e (run, line, label)."""
    size = e.shape[1]
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0]
    for t in range(1, size):
        nxt = np.logaddexp(alpha[:, t - 1, :1] + move[0], alpha[:, t - 1, 1:] + move[1]) + e[:, t]
        alpha[:, t] = np.where(mask[:, t, None], nxt, alpha[:, t - 1])
    for t in range(size - 2, -1, -1):
        ahead = e[:, t + 1] + beta[:, t + 1]
        prev = np.logaddexp(ahead[:, :1] + move[:, 0], ahead[:, 1:] + move[:, 1])
        beta[:, t] = np.where(mask[:, t + 1, None], prev, 0)
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
    share = np.exp(alpha + beta - z[:, :, None]) * mask[:, :, None]
    both, pairs = mask[:, 1:] & mask[:, :-1], np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = (np.exp(alpha[:, :-1, a] + move[a, b] + e[:, 1:, b] + beta[:, 1:, b] - z) * both).sum()
    return share, pairs


def train(features: np.ndarray, lines_of: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.3, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Emission (features x 2) and transition (2 x 2) weights of greatest penalised likelihood of the allowed labels."""
    open_ = allowed(features, lines_of, labels)
    kinds, code = np.unique(features, axis=0, return_inverse=True)
    runs = [(a, min(a + WINDOW, stop)) for stop, n in zip(np.cumsum(lines_of), lines_of) for a in range(stop - n, stop, WINDOW)]
    size = max(b - a for a, b in runs)
    x, mask, shut = np.zeros((len(runs), size), dtype=np.int64), np.zeros((len(runs), size), dtype=bool), np.zeros((len(runs), size, 2))
    for i, (a, b) in enumerate(runs):
        x[i, : b - a], mask[i, : b - a], shut[i, : b - a] = code.ravel()[a:b], True, np.where(open_[a:b], 0.0, -1e4)
    emit, move = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    moments = [np.zeros_like(emit), np.zeros_like(move), np.zeros_like(emit), np.zeros_like(move)]
    n = mask.sum()
    for step in range(1, rounds + 1):
        e = (kinds @ emit)[x]
        wanted, wanted_pairs = _expected(e + shut, move, mask)
        found, found_pairs = _expected(e, move, mask)
        gap = np.stack([np.bincount(x.ravel(), (wanted - found)[:, :, k].ravel(), len(kinds)) for k in (0, 1)], axis=1)
        for k, (w, g) in enumerate(((emit, kinds.T @ gap), (move, wanted_pairs - found_pairs))):
            g = g / n - ridge * w
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[k + 2] = 0.99 * moments[k + 2] + 0.01 * g * g
            w += rate * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 2] / (1 - 0.99**step)) + 1e-9)
    return emit, move


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The likeliest label of each line (1: content); ties go to content."""
    (m00, m01), (m10, m11) = move.tolist()
    back, (a, b) = [], scores[0].tolist()
    for e0, e1 in scores[1:].tolist():
        from0, from1 = b + m10 >= a + m00, b + m11 >= a + m01
        back.append((from0, from1))
        a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1])


def _groups(texts: pd.Series):
    held, chars = [], 0
    for t in texts:
        held.append(t or "")
        chars += len(held[-1])
        if chars >= GROUP_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED):
    """The trained weights, or None without labels of both kinds."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    marks = marks.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    found = {r.id: int(r.y) for r in marks.collect()}  # max_labelled rows at most
    if len(set(found.values())) < 2:
        return None
    ids = docs.sparkSession.createDataFrame([(k,) for k in found], StructType([StructField("id", labels.schema[id_col].dataType)]))

    @F.pandas_udf("lines long, features binary")
    def lines(texts: pd.Series) -> pd.DataFrame:
        parts = [measure([t]) for t in texts]
        return pd.DataFrame({"lines": [int(p[1][0]) for p in parts], "features": [p[2].astype(np.uint8).tobytes() for p in parts]})

    sample = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    # of texts that share an id, that of the least hash counts
    one = sample.select("id", F.struct(F.xxhash64("text").alias("h"), lines("text").alias("m")).alias("x")).groupBy("id").agg(F.min("x").alias("x")).select("id", "x.m")
    rows = sorted(one.collect(), key=lambda r: r.id)  # one row a labelled id, bits of features only
    if len({found[r.id] for r in rows}) < 2:
        return None
    features = np.frombuffer(b"".join(bytes(r.m.features) for r in rows), dtype=np.uint8).reshape(-1, FEATURES).astype(float)
    return train(features, np.array([r.m.lines for r in rows]), np.array([found[r.id] for r in rows]))


def label_quality(docs: DataFrame, model, text_col: str = "text", out_col: str = "quality", least_share: float = LEAST_SHARE) -> DataFrame:
    """Add a struct: the five statistics, base_failed, content_share and kept."""

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        out = []
        for group in _groups(texts):
            stats, lines_of, features, words = measure(group)
            scores = features @ model[0] if model else None
            stop = 0
            for s, n in zip(stats.tolist(), lines_of.tolist()):
                start, stop = stop, stop + n
                if model and s[0]:
                    share = float(words[start:stop][viterbi(scores[start:stop], model[1]) == 1].sum() / s[0])
                else:
                    share = 1.0
                out.append((*s, share))
        return pd.DataFrame(out, columns=[*STATS, "content_share"])

    stats = docs.withColumn("__q", judge(text_col))
    failed = (F.col("__q.n_words") < 50) | (100 * F.col("__q.n_repeat_words") > 50 * F.col("__q.n_words"))
    kept = ~failed & (F.col("__q.content_share") >= least_share)
    return stats.withColumn(out_col, F.struct("__q.*", failed.alias("base_failed"), kept.alias("kept"))).drop("__q")


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    judged = label_quality(docs, fit(docs, labels), out_col="__quality")
    return judged.filter(F.col("__quality.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_quality_rules(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = label_quality(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in (*STATS, "base_failed", "kept", "content_share")])


QUERIES = {"op8_quality_rules": op8_quality_rules}
SQL: dict[str, str] = {}
