import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestrata.llm import simhash
from tidestrata.llm.components import connected


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) rows with columns that clash with names used inside."""

    def make(rows):
        full = [(i, t, "x", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, _key string, first int")

    return make


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aAbBÉé \n\t\x1c\x85", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) % 2**64 == plain_fingerprint(text)


def test_fingerprint_of_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=100))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.simhash(text.encode()) % 2**64 == plain_fingerprint(text)
    assert simhash.simhash(None) == simhash.simhash(b"") == simhash.simhash(b" \n") == 0


def brute(rows, radius=2):
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    first = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            first[g] = min(i, first.get(g, i))
    return sorted(((i, f"{p:016x}", first.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)


def test_groups_equal_brute_force(spark, documents):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for base in range(12):
        text = rng.choices(words, k=rng.choice([3, 40, 900]))
        for _ in range(5):
            text = list(text)
            text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(900, None), (901, ""), (None, " "), (902, "one"), (902, "one"), (None, "two words"), (7, rows[3][1])]
    found = simhash.near_duplicates(documents(rows)).select("id", "fingerprint", "first_id").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    kept = simhash.without_near_duplicates(documents(rows))
    assert kept.columns == ["doc_id", "text", "_key", "first"]
    groups = {r[2] for r in brute(rows)}
    assert {r.doc_id for r in kept.collect()} == groups - {None} | {None}


def test_empty(spark, documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.without_near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("tile", [1, 7, 1000])
def test_links_connect_all_near_pairs(spark, tile):
    rng = random.Random(tile)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:30]:
        prints |= {p ^ 1 << rng.randrange(64), p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    prints = sorted(prints | {0, 2**64 - 1, 1, 2**64 - 2})
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = {tuple(r) for r in simhash.near_fingerprints(frame, tile=tile).collect()}
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in links)

    def parts(pairs):
        group = {p: p for p in signed}
        for a, b in pairs:
            x, y = group[a], group[b]
            group = {p: min(x, y) if g in (x, y) else g for p, g in group.items()}
        return group

    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 2]
    assert parts(links) == parts(near)


def test_tiles_of_one_large_group():
    tile = np.array([1 << i for i in range(20)], np.int64)
    links = simhash.tile_links(tile, tile, True, 2)
    assert len(links) == 19


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (7, 6)]
    frame = spark.createDataFrame(chain, "a bigint, b bigint")
    found = {r.node: r.component for r in connected(frame).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert connected(frame.where("a < 0")).count() == 0
