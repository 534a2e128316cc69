"""Fuzzy search for short licence notices.

A text is lower-cased (A-Z), cut into words and joined by single spaces. A notice that may hold k errors is split into
k + 1 pieces; by the pigeonhole principle any match holds one piece exactly, so an Aho-Corasick pass over the pieces
finds every candidate place. There the regex library's bounded-error matching verifies the notice and counts the edits.
Besides the notices, exact base phrases give labels of their own.

Work is one pass inside map tasks: nothing is shuffled, and memory is that of a batch of texts.

Nulls: a null text counts as empty: no words, no labels, score 0. Ids, repeated rows and other columns pass through;
an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import documents

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Openings of public licence notices, as words.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "subject to the terms of the mozilla public license v 2 0": "mpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: One error is allowed for so many characters.
CHARS_AN_ERROR = 12

#: Lower-cases A-Z and turns all other ASCII but digits and letters into blanks; bytes from 0x80 on are parts of words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,last_word:long,errors:int,score:double>>"


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], chars_an_error: int):
        import ahocorasick
        import regex

        self.base = [(f" {p} ", label) for p, label in base.items()]
        self.rules, self.pieces = [], ahocorasick.Automaton()
        at: dict[str, list] = {}
        for notice, label in notices.items():
            k = len(notice) // chars_an_error
            cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                at.setdefault(notice[a:b], []).append((len(self.rules), b))
            self.rules.append((regex.compile(rf"(?b)(?:{regex.escape(notice)}){{e<={k}}}"), len(notice), k, label))
        for piece, uses in at.items():
            self.pieces.add_word(piece, uses)
        self.pieces.make_automaton()

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode().translate(_TABLE).split()
        flat = f" {b' '.join(words).decode()} " if words else ""
        starts: list[int] | None = None

        def word_at(pos: int) -> int:
            nonlocal starts
            if starts is None:
                starts = np.flatnonzero(np.frombuffer(flat.encode("utf-32-le"), dtype="<u4") == 32).tolist()
            return bisect.bisect_right(starts, pos) - 1

        places, base_labels = [], set()
        for phrase, label in self.base:
            pos = flat.find(phrase)
            while pos >= 0:
                places.append(word_at(pos + 1))
                base_labels.add(label)
                pos = flat.find(phrase, pos + 1)
        tries: dict[int, set[int]] = {}
        for end, uses in self.pieces.iter(flat):
            for rule, offset in uses:
                tries.setdefault(rule, set()).add(end + 1 - offset)
        spans = []
        for rule, wanted in tries.items():
            pattern, size, k, label = self.rules[rule]
            done = -1
            for start in sorted(wanted):
                if start < done:
                    continue
                m = pattern.search(flat, max(0, start - k), start + size + 2 * k)
                if m:
                    errors = sum(m.fuzzy_counts)
                    spans.append((label, word_at(m.start() + (flat[m.start()] == " ")), word_at(max(m.end() - 1, 0)), errors, 1 - errors / size))
                    done = m.end()
        spans.sort()
        score = 1.0 if places else max((s[4] for s in spans), default=0.0)
        labels = base_labels | {s[0] for s in spans}
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, spans


def scan_licenses(docs: DataFrame, text_col: str = "text", out_col: str = "license", base: dict[str, str] | None = None, notices: dict[str, str] | None = None, chars_an_error: int = CHARS_AN_ERROR) -> DataFrame:
    """Add a struct: words, base places, labels, best score and the verified spans (by word, last word included)."""
    base, notices = base or BASE, notices or NOTICES
    held: list[Scanner] = []

    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(Scanner(base, notices, chars_an_error))
        found = pd.DataFrame([held[0].scan(t) for t in texts], columns=[x.split()[0] for x in RESULT.split(", ")])
        return found.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn(out_col, scan(text_col))


def op1_license_scan(spark, sf_dir):
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[F.col(f"license.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


QUERIES = {"op1_license_scan": op1_license_scan}
SQL: dict[str, str] = {}
