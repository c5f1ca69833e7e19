"""Exact copies, shared lines, repeated passages, benchmark items and URL rules against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidestrata.llm import decontaminate, hash_index, line_spread, unit_dedup, url_rules

@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) rows with columns that clash with names used inside."""

    def make(rows):
        full = [(i, t, "x", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, _key string, first int")

    return make


EDGES = [(50, None), (51, ""), (None, "Lone"), (52, "same"), (52, "same"), (None, None), (53, "SAME"), (54, "É"), (55, "é")]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    result = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            result.append((i, keep, len(ids), i == keep and not kept, sha))
            kept |= i == keep
    return sorted(result, key=str)


def test_exact_duplicates(documents):
    rows = EDGES + [(i, f"text {i % 7}") for i in range(30)] + [(99, "long " * 50_000), (98, "Long " * 50_000)]
    found = hash_index.exact_duplicates(documents(rows))
    assert sorted(map(tuple, found.collect()), key=str) == brute_copies(rows)
    kept = hash_index.without_exact_duplicates(documents(rows))
    assert kept.columns == ["doc_id", "text", "_key", "first"]
    expected = sorted((r[0] for r in brute_copies(rows) if r[3]), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == expected
    assert hash_index.exact_duplicates(documents([])).count() == 0
    assert hash_index.without_exact_duplicates(documents([])).count() == 0


def test_collisions_are_told_apart_by_bytes(documents, monkeypatch):
    monkeypatch.setattr(hash_index.F, "xxhash64", lambda *_: F.lit(5).cast("bigint"))
    rows = [(1, "a"), (2, "b"), (3, "A"), (4, "c")]
    assert sorted(map(tuple, hash_index.exact_duplicates(documents(rows)).collect())) == brute_copies(rows)


def test_the_index_decides(documents, monkeypatch):
    """A directory without its first bucket loses that bucket's texts; one split in two keeps all."""
    rows = [(i, f"text {i % 40}") for i in range(200)]
    monkeypatch.setattr(hash_index, "BUCKET_HASHES", 5)
    real = hash_index.directory

    def broken(keys, capacity):
        leaves, depth = real(keys, 5)
        return leaves.where("prefix > 0"), depth

    def small(keys, capacity):
        return real(keys, 5)

    monkeypatch.setattr(hash_index, "directory", small)
    expected = brute_copies(rows)
    assert sorted(map(tuple, hash_index.exact_duplicates(documents(rows)).collect()), key=str) == expected
    monkeypatch.setattr(hash_index, "directory", broken)
    lost = sorted(map(tuple, hash_index.exact_duplicates(documents(rows)).collect()), key=str)
    assert lost != expected and set(lost) < set(expected)


def test_owners_have_key_ranges_and_chain_without_another_shuffle(documents):
    """Every owner's hashes lie between those of its neighbours, and grouping follows dealing in one stage."""
    rows, index = hash_index.duplicate_index(documents([(i, f"text {i % 60}") for i in range(240)]), "doc_id", "text", 4)
    own = defaultdict(list)
    for row in index.collect():
        own[row.owner].append(row.key % 2**64)
    ordered = [(min(own[o]), max(own[o])) for o in sorted(own)]
    assert len(ordered) > 3 and all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("capacity", [1, 3, 1000])
def test_directory(spark, capacity):
    rng = random.Random(3)
    keys = {rng.getrandbits(64) - 2**63 for _ in range(200)} | {5, 6, 7, 8}
    leaves, depth = hash_index.directory(spark.createDataFrame([(k,) for k in keys], "key bigint"), capacity)
    counts = defaultdict(int)
    rows = leaves.collect()
    for row in rows:
        assert row.hashes <= capacity and row.depth <= depth
        own = [k for k in keys if k % 2**64 >> (64 - row.depth) == row.prefix % 2**64] if row.depth else keys
        assert len(own) == row.hashes
        counts[row.depth, row.prefix] += 1
    assert sum(r.hashes for r in rows) == len(keys) and set(counts.values()) == {1}


def test_buckets_own_key_ranges(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    leaves, depth = hash_index.directory(keys, 20)
    owned = hash_index.with_bucket(keys, leaves, depth).collect()
    assert len(owned) == 500
    for row in owned:
        assert row.key % 2**64 >> (64 - row.bucket_depth) == row.bucket


def test_shared_lines(spark):
    rows = [(i, f"s{i % 6}", "Common  line\nown %d\n\nhalf" % i if i % 2 else "COMMON line\nhalf") for i in range(12)]
    rows += [(20, None, "common line"), (21, "s9", None), (22, "s9", ""), (None, "s1", "common line\nmine"), (23, "s1", "only here"), (23, "s1", "only here")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, source string, text string, sites int")
    found = {(r.doc_id, r.text, tuple(r.removed_lines)) for r in line_spread.without_shared_lines(docs).collect()}
    assert {(1, "own 1\n", (0, 3)), (0, "", (0, 1)), (20, "", (0,)), (21, None, ()), (22, "", ()), (None, "mine", (0,)), (23, "only here", ())} <= found
    assert line_spread.without_shared_lines(docs).columns == [*docs.columns, "removed_lines"]
    assert line_spread.without_shared_lines(docs.limit(0)).count() == 0
    many = spark.range(4000).selectExpr("id", "concat('s', id % 1000) source", "if(id < 3996, 'a', concat('b', id)) text")
    lines = line_spread.lines_of(many, "source", "text")
    assert line_spread.shared_lines(lines, 1000).count() == 1 and line_spread.shared_lines(lines, 1001).count() == 0


def plain_units(text):
    found, start = [], 0
    for line in (text or "").split("\n"):
        at = start
        for piece in re.split(r"(?<=[.!?])(?=\s)", line):
            words = re.findall(r"[^\W_]+", piece.lower())
            if len(words) >= 5:
                found.append((at, at + len(piece), " ".join(words)))
            at += len(piece)
        start += len(line) + 1
    return found


def test_units_of_a_text():
    text = "One two three four five. Six!\nA b c d e f\n3.5 is a number here, so no. É è ê ë ì? x"
    found = unit_dedup.units_of(text)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in plain_units(text)]
    assert unit_dedup.units_of(None) == unit_dedup.units_of("") == []
    assert len(unit_dedup.units_of("a b c d e\nf g h i j\n\nk l m n o", "paragraph")) == 2
    assert len(unit_dedup.units_of("a b c d e. f g h i j", "line")) == 1


def test_repeated_units(documents):
    rng = random.Random(2)
    sentences = [" ".join(rng.choices("abcdefgh", k=6)).capitalize() + "." for _ in range(12)]
    rows = [(i, "\n".join(" ".join(rng.choices(sentences, k=3)) for _ in range(3))) for i in range(20)]
    rows += [(30, None), (31, ""), (None, sentences[0]), (32, "unlike anything else that is here"), (32, "unlike anything else that is here")]
    first = {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for start, _, words in plain_units(text):
            first.setdefault(words, (i, start))
    docs = documents(rows)
    result = unit_dedup.without_repeated_units(docs)
    assert result.columns == [*docs.columns, "removed"]
    found = {(r.doc_id, r.text, tuple(map(tuple, r.removed))) for r in result.collect()}
    expected = set()
    for i, text in rows:
        cuts = [(a, b, *first[w]) for a, b, w in plain_units(text) if first[w] != (i, a)]
        kept = text
        for a, b, *_ in reversed(cuts):
            kept = kept[:a] + kept[b:]
        expected.add((i, kept, tuple(cuts)))
    assert found == expected
    assert unit_dedup.without_repeated_units(documents([])).count() == 0


def brute_matches(docs, items):
    result = []
    for i, text in docs:
        words = decontaminate.words_of(text)
        for item, passage in items:
            own = decontaminate.words_of(passage)
            wanted = decontaminate.shingles_of(own)
            size = min(5, len(own))
            have = set(zip(*(words[k:] for k in range(size)))) if own else set()
            if wanted and len(wanted & have) / len(wanted) >= 0.8:
                result.append((i, item, len(wanted & have), len(wanted)))
    return sorted(result, key=str)


@pytest.mark.parametrize("block_bytes", [10_000_000, 700])
def test_contaminated(spark, documents, block_bytes):
    rng = random.Random(9)
    items = [(k, " ".join(rng.choices("abcdefghijklmn", k=rng.choice([1, 3, 5, 9, 14, 40])))) for k in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (3, items[3][1]), (None, items[4][1])]
    rows = []
    for k in range(60):
        words = rng.choices("abcdefghijklmn", k=rng.choice([3, 60, 3000]))
        for _, text in rng.choices(items, k=2):
            passage = (text or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if passage:
                    passage[rng.randrange(len(passage))] = rng.choice("xyz")
            at = rng.randrange(len(words))
            words[at:at] = passage
        rows.append((k, ", ".join(words).upper()))
    rows += [(90, None), (91, ""), (None, items[5][1]), (92, items[6][1]), (92, items[6][1])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(documents(rows), table, block_bytes=block_bytes)
    assert sorted((tuple(r)[:4] for r in found.collect()), key=str) == brute_matches(rows, items)
    clean = decontaminate.without_contaminated(documents(rows), table, block_bytes=block_bytes)
    assert clean.columns == ["doc_id", "text", "_key", "first"]
    dirty = {r[0] for r in brute_matches(rows, items)}
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - dirty
    assert decontaminate.contaminated(documents(rows), table.limit(0)).count() == 0
    assert decontaminate.contaminated(documents([]), table).count() == 0


RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def test_words_are_found_whatever_their_case(spark):
    """The word has to stand alone in lower case; a named rule's path is compared as it is."""
    urls = ["http://a.net/CASINO/play", "http://a.net/casino", "http://a.net/Xcasino", "http://a.net/xCASINOs", "http://b.org/EN/1"]
    rules = url_rules.rule_table(spark, [("block", "b.org/en/1")])
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    found = {r.url: (r.pattern_rule, r.verdict, r.path) for r in url_rules.judged(pages, rules).collect()}
    assert [found[u] for u in urls] == [
        ("casino", "block", "/CASINO/play"), ("casino", "block", "/casino"), (None, "allow", "/Xcasino"),
        (None, "allow", "/xCASINOs"), (None, "allow", "/EN/1"),
    ]


def test_url_rules(spark):
    urls = [
        "http://Blog.Example.org/en/1234?x#y", "https://example.org/en/2", "http://notexample.org/es/", "http://a.example.org/es/x",
        "http://x.com/de/1", "http://x.com/DE/1", "http://com/fr/", "http://x.com?/de/", "http://x.net/de/", "x.org/", None, "",
        "http://x.org", "http://x.net/casino/play", "http://xcasino.net/", "ftp://b.org:80/", "http://x.net/a?casino", "a://b://c.org/",
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[:1])], "page_id bigint, url string, key string")
    judged = url_rules.judged(pages, url_rules.rule_table(spark, RULES))
    found = {r.page_id: r for r in judged.collect()}
    assert judged.columns[:3] == pages.columns and len(found) == len(urls) + 1
    for i, url in enumerate(urls + urls[:1]):
        _, sep, rest = (url or "").partition("://")
        host = lower(re.match(r"[^/?#]*", rest)[0]) if sep else ""
        path = re.match(r"[^?#]*", rest[len(host):])[0] if sep else ""
        fits = [(len(s), s, v) for v, s in RULES if ("." + host).endswith("." + s.partition("/")[0]) and path.startswith("/" + s.partition("/")[2])]
        rule = max(fits, default=(0, None, "block" if i == 13 else "allow"))
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, *rule[1:]), url
        assert found[i].pattern_rule == ("casino" if i == 13 else None)
    assert url_rules.judged(pages.limit(0), url_rules.rule_table(spark, RULES)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    places = spark.createDataFrame([("www.example.org/en/", 9), ("example.net/es/", 1)], "place string, n bigint")
    index = url_rules.rule_index(url_rules.rule_table(spark, [("block", "example.org/en/1"), ("allow", "org/"), ("block", "zzz.example/")], ()), places)
    assert {r.rule: r.key for r in index.collect()} == {"example.org/en/1": "en", "org/": "org", "zzz.example/": "zzz"}
