"""Removal of repeated byte strings against counting every string."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidestrata.llm import queries, suffix_index
from tidestrata.llm.oracles import ORACLES
from workload.compare import TESTDATA, oracle_rows, ordered

LENGTH = suffix_index.LENGTH


def brute(texts):
    """(bytes, bytes removed, runs removed, digest of the rest) per text."""
    counts = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    result = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if counts[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, x in zip(t, gone) if not x)
        runs = sum(len(r) > 0 for r in bytes(gone).split(b"\0"))
        result.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return result


def measures(frame):
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return frame.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256))


def corpus(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    passages = [prose(draw.randint(25, 120)) for _ in range(6)]
    texts = [None, "", "x" * 199, "x" * 200, "x" * 201, "ab" * 300, "ab" * 100, prose(2500)]
    for _ in range(60):
        text = prose(draw.randint(0, 150))
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            text += passage[draw.randint(0, 30) : len(passage) - draw.randint(0, 30)] + prose(draw.randint(0, 40))
        texts.append(text)
    texts += [texts[20]] * 3 + [texts[7][:9000] + "Z" + texts[7][9000:], "the same line\n" * 100]
    return list(enumerate(texts)) + [(5, texts[9]), (5, texts[9]), (None, texts[11]), (None, None)]


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"batches": 5, "owned": 60, "hot": 3})])
def test_every_repeated_string_goes(spark, seed, settings):
    """The second case merges levels twice, and deals crowded sequences out string by string."""
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit("x").alias("kept"), F.lit(1).alias("k1"), F.lit(2).alias("_data")
    )
    cut = suffix_index.without_repeats(docs, **settings)
    assert cut.columns == ["doc_id", "text", "k1", "_data", "kept", "n_bytes", "spans"]
    found = Counter(map(tuple, measures(cut).collect()))
    plain = brute([(t or "").encode() for _, t in rows])
    assert found == Counter((i, *p) for (i, _), p in zip(rows, plain))


def test_strings_across_strides(spark, monkeypatch):
    """A text looked at in parts owns every string once."""
    whole = ("".join(random.Random(3).choice("abcd") for _ in range(3000)) * 2).encode()
    hashes, places = suffix_index.anchors(whole)
    monkeypatch.setattr(suffix_index, "STRIDE", 512)
    for found in (places, suffix_index.anchors(whole)[1]):
        owned = [p - before + k for p, before, n in ((x >> 16, x >> 8 & 255, (x & 255) + 1) for x in found.tolist()) for k in range(n)]
        assert sorted(owned) == list(range(len(whole) - LENGTH + 1))


def test_nothing_to_do(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_index.without_repeats(docs).count() == 0
    docs = spark.createDataFrame([(1, None), (2, "short")], "doc_id bigint, text string")
    assert [(r.doc_id, r.n_bytes, r.spans) for r in suffix_index.without_repeats(docs).sort("doc_id").collect()] == [
        (1, 0, []), (2, 5, [])
    ]


def test_query_equals_sql(spark):
    frame = queries.op11_suffix_index(spark, f"{TESTDATA}/sf0.001")
    columns, _, theirs = oracle_rows(f"{TESTDATA}/sf0.001", ORACLES["op11_suffix_index"])
    assert ordered(frame.columns, map(tuple, frame.collect())) == ordered(columns, theirs)
