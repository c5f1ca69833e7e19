"""Phrases against counting every run of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidestrata.llm import collocations, queries
from tidestrata.llm.oracles import ORACLES
from workload.compare import TESTDATA, oracle_rows, ordered


def brute(rows, frequent=30, best=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", text):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: n for key, n in counts.items() if n >= frequent}
    found = []
    for (lang, w), a in often.items():
        if len(w) == 1:
            continue
        covered = any(
            len(v) > len(w)
            and language == lang
            and 100 * n >= 80 * a
            and any(v[i : i + len(w)] == w for i in range(len(v)))
            for (language, v), n in often.items()
        )
        if not covered:
            cuts = [(often[lang, w[:k]], often[lang, w[k:]], k) for k in range(1, len(w))]
            score, _, left, right = min((2000000 * a // (x + y), k, x, y) for x, y, k in cuts)
            found.append((lang, -score, -a, " ".join(w).encode(), left, right))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= best:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["to", "be", "É", "é", "or", "NOT", "x\x00", "a b", "😀", "z"] + [f"w{i}" for i in range(20)]
    rows = []
    for _ in range(n):
        text = "".join(
            draw.choice(words[: draw.choice((4, 10, 30))]) + draw.choice((" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "; "))
            for _ in range(draw.randint(0, 60))
        )
        rows.append((draw.choice(("en", "en", "de", "", None)), text))
    return rows + [("en", None), (None, ""), ("fr", "la la " * 40), ("fr", "one two three four five " * 35), ("en", "to be " * 3000)]


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("settings", [{}, {"block": 300, "best": 7, "owned": 900}])
def test_phrases_equal_plain_counts(spark, settings):
    """The second case cuts texts at breaks into many blocks and deals units to many owners."""
    rows = corpus(4, 250)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {"unit": F.lit(1), "id": F.lit("x"), "n": F.lit(2)}
    )
    assert found(collocations.collocations(docs, **settings)) == brute(rows, best=settings.get("best", 2000))


def test_dense_and_sparse_tiles():
    draw = np.random.default_rng(5)
    first, second = draw.integers(0, 1500, (2, 200_000))
    near = draw.integers(0, 30, (2, 200_000))
    first, second = np.r_[first, near[0], 5_000_000], np.r_[second, near[1], 7_000_000]
    a, b, n = collocations.counted(first, second)
    plain = Counter(zip(first.tolist(), second.tolist()))
    assert len(a) == len(plain) and dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == plain


def test_products_beyond_64_bits(spark):
    """Counts that only a far larger corpus has go through the same expressions."""
    f = 9_000_000_000_000_000
    row = [(0, "en", "a b", f, [f, f], [f + 7, f])]
    frame = spark.createDataFrame(row, "id int, lang string, phrase string, f long, starts array<long>, ends array<long>")
    assert collocations._scored(frame, 2).first().score == 2_000_000 * f // (2 * f + 7)


def test_nothing_frequent(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    docs = spark.createDataFrame([("en", "a few words"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).count() == 0


def test_query_equals_sql(spark):
    frame = queries.op12_collocations(spark, f"{TESTDATA}/sf0.001")
    columns, kinds, theirs = oracle_rows(f"{TESTDATA}/sf0.001", ORACLES["op12_collocations"])
    assert {c: k for c, k in frame.dtypes} == {c: {"varchar": "string"}.get(k, k) for c, k in kinds.items()}
    assert len(theirs) > 40 and ordered(frame.columns, map(tuple, frame.collect())) == ordered(columns, theirs)
