"""Chat trees, packing, archives, toxicity, and the pipeline against plain versions."""

import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tidestrata.llm import chat, packing, queries, simhash, toxicity, warc

@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) rows with columns that clash with names used inside."""

    def make(rows):
        full = [(i, t, "x", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, _key string, first int")

    return make


HARD = "<|im_end|><|im_start|>assistant ok"


@given(st.text(alphabet="<|\\n\nima_>é", max_size=30))
@settings(max_examples=200, deadline=None)
def test_template_is_reversible(text):
    assert chat.restored(chat.escaped(text)) == text and "<|" not in chat.escaped(text)
    assert chat.restored_role(chat.escaped_role(text)) == text and "\n" not in chat.escaped_role(text)
    head, body, tail = chat.turn_parts(text, text)
    assert chat.parsed_turn(head, body) == (text, text)
    assert (head + body + tail).count(chat.END) == 1


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        shared = ["hello", "hi there", "so?"][: rng.randrange(4)]
        turns = shared + ["say %d" % rng.randrange(4) for _ in range(rng.randrange(1, 5))]
        rows += [(conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]
    rows += [(70, 0, None, None), (70, 1, "assistant", None), (71, 5, "assistant", HARD), (71, 3, "user", HARD)]
    rows += [(None, 0, "user", "x"), (72, 0, "a\nb", "y" * 30_000), (76, 0, "user", " " * 300_000 + HARD), (73, 0, "user", "same"), (73, 0, "user", "same")]
    rows += [(74, 0, "user", "a <|im_start|> \\ é"), (75, None, "assistant", "late"), (75, 0, "user", "")]
    return rows


def test_prefix_tree(spark):
    rows = conversation_rows()
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, node string")
    segments, leaves = chat.prefix_tree(turns, queries.vocabulary())
    wanted = defaultdict(list)
    for conv, turn, role, text in rows:
        wanted[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    paths = {c: [(r, t) for _, r, t in sorted(v)] for c, v in wanted.items()}
    nodes = {tuple(p[: k + 1]) for p in paths.values() for k in range(len(p))}
    rows_of = segments.collect()
    assert len(rows_of) == len(nodes)

    by_tree = defaultdict(list)
    for s in rows_of:
        by_tree[s.tree].append(s)
    encoder = packing.BytePairEncoder(queries.vocabulary())
    seen = set()
    for tree in by_tree.values():
        at, stack = 0, []
        for s in sorted(tree, key=lambda s: s.offset):
            assert s.offset == at and s.length == len(s.ids)
            at += s.length
            stack = stack[: s.depth]
            assert len(stack) == s.depth and s.position == sum(a.length for a in stack)
            covered = {x for i in s.attends for x in range(i.start, i.stop)}
            assert covered == {x for a in stack for x in range(a.offset, a.offset + a.length)}
            assert all(a.stop < b.start for a, b in zip(s.attends, s.attends[1:]))
            stack.append(s)
            seen.add("".join(encoder.decode(a.ids) for a in stack))
    assert seen == {"".join("".join(chat.turn_parts(*t)) for t in n) for n in nodes}
    found = {c.conv_id: c.turns for c in chat.conversations(segments, leaves, queries.vocabulary()).collect()}
    assert {c: [(t.role, t.text) for t in v] for c, v in found.items()} == paths
    assert {c: [t.loss for t in v] for c, v in found.items()} == {
        c: [t if r == "assistant" else None for r, t in v] for c, v in paths.items()
    }
    empty = chat.prefix_tree(turns.limit(0), queries.vocabulary())
    assert empty[0].count() == empty[1].count() == 0


def test_pieces_have_the_ids_of_the_vocabulary(spark, documents):
    import public_tokenizers

    rng = random.Random(1)
    texts = [None, "", "a", " \n\n <|endoftext|> it's 12é ñ  " * 3, "x" * 5000, "a" + " " * 300_000 + "b <|endoftext|>", "\n" * 300_000] + [" ".join(rng.choices(["the", "Ñu", "don't", "\t", "1234"], k=k)) for k in (2047, 2048, 9000)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, texts[3])]
    tokens = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tokens.encode_special_tokens = True
    expected = []
    for i, text in rows:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            data = b"".join(x.to_bytes(4, "little") for x in ids[a:b])
            expected.append((i, k, a, b - a, zlib.crc32(data)))
    placed = packing.packed(packing.token_pieces(documents(rows), queries.vocabulary())).collect()
    assert sorted((tuple(r)[:5] for r in placed), key=str) == sorted(expected, key=str)
    check_places(placed)
    assert packing.packed(packing.token_pieces(documents([]), queries.vocabulary())).count() == 0


def check_places(placed, capacity=2048):
    ends = defaultdict(int)
    for row in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends[row.sequence_id]
        ends[row.sequence_id] += row.length
    assert max(ends.values()) <= capacity
    return len(ends)


@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_bins_equal_plain_best_fit(lengths, most):
    bins, plain, made = packing.OpenBins(20, most), [], 0
    for length in lengths:
        number, offset = bins.place(length)
        fitting = [b for b in plain if b[1] >= length]
        space = min((b[1] for b in fitting), default=20)
        assert offset == 20 - space
        if fitting:
            own = next(b for b in plain if b[0] == number)
            assert own[1] == space
            own[1] -= length
        else:
            assert number == made
            made += 1
            plain.append([number, 20 - length])
        plain = [b for b in plain if b[1]]
        if len(plain) > most:
            # Of equally full ones the operator says which closed by not using it again.
            fullest = min(b[1] for b in plain)
            closed = next(b for b in plain if b[1] == fullest and b[0] not in bins.by_space[fullest])
            plain.remove(closed)
        assert sorted(b[1] for b in plain) == sorted(s for s, x in enumerate(bins.by_space) for _ in x)
    with pytest.raises(ValueError):
        bins.place(21)


def test_packing_is_close_to_full(spark):
    rng = random.Random(8)
    rows = [(i, 0, 0, min(2048, int(rng.lognormvariate(6, 1)) + 1), 0) for i in range(20_000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    used = check_places(packing.packed(pieces).collect())
    assert used <= 1.002 * sum(r[3] for r in rows) / 2048


def page_rows():
    long = "é" * 600
    rows = [(i, f"http://x/{i}?a=é b%20", long if i % 3 else f"page {i} " * 300) for i in range(30)]
    rows += [(40, None, None), (41, "", ""), (None, "http://n", long), (42, "u", "short"), (43, "u", "short"), (44, "v\r\nX: y", "z" * 999)]
    return rows + [(45, "w", "q" * 1000), (45, "w", "q" * 1000), (46, "r", "\x1f\x8b\x08" * 400)]


def plain_archive(rows):
    result = []
    for i, url, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        refers = max(ids) if len(data) >= 1000 and ids and i != max(ids) else None
        result.append((i, url, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(result, key=str)


@pytest.mark.parametrize("range_bytes", [50, 1000, 8_000_000])
def test_archives(spark, tmp_path, range_bytes):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, sha int")
    path = f"{tmp_path}/warc"
    warc.write_archive(pages, path)
    records = warc.resolved(warc.read_archive(spark, path, range_bytes)).collect()
    found = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records]
    assert sorted(found, key=str) == plain_archive(rows)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == len(rows)


def test_archive_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(pages).count() == 0


def test_schemes_of_stores():
    assert warc.store_uri("s3a://bucket/s3a:x") == "s3://bucket/s3a:x"
    assert warc.store_uri("file:/tmp/x") == "file:/tmp/x"


def test_long_records_and_damage(tmp_path):
    data = warc.record_bytes(1, "u", random.Random(1).randbytes(17_000_000), None, False)
    member = warc.gzip_member(data)
    assert member[-1] == 0 and gzip.decompress(member) == data
    file = tmp_path / "a"
    file.write_bytes(b"\x1f\x8b\x08junk" + member + warc.gzip_member(b"no record"))
    assert [p for p, _ in warc.owned_members(f"file://{file}", 0, len(member) + 100)] == [7]
    assert list(warc.owned_members(f"file://{file}", 8, len(member) + 100)) == []
    file.write_bytes(member[:-1000])
    with pytest.raises(ValueError, match="breaks off"):
        list(warc.owned_members(f"file://{file}", 0, 10))
    assert warc.parsed(data)["payload_digest"] == hashlib.sha1(data.partition(b"\r\n\r\n")[2][:17_000_000]).hexdigest()


def plain_marginals(unary, first, moves):
    """Sums over all state sequences of each text."""
    from itertools import product

    weight = np.array([[0, moves[0]], [moves[1], moves[2]]])
    result = []
    starts = [i for i, f in enumerate(first) if f] + [len(unary)]
    for a, b in zip(starts, starts[1:]):
        total, toxic = 0.0, np.zeros(b - a)
        for states in product((0, 1), repeat=b - a):
            w = np.exp(sum(u * s for u, s in zip(unary[a:b], states)) + sum(weight[x][y] for x, y in zip(states, states[1:])))
            total += w
            toxic += w * np.array(states)
        result += list(toxic / total)
    return np.array(result)


def test_forward_backward(monkeypatch):
    monkeypatch.setattr(toxicity, "STRETCH", 3)
    rng = np.random.default_rng(2)
    first = np.array([1, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 1], bool)
    unary, moves = rng.normal(0, 2, len(first)), np.array([-1.0, 0.5, 1.5])
    p, forward, back = toxicity.marginals(unary, first, moves)
    assert np.allclose(p, plain_marginals(unary, first, moves))
    step, numeric = 1e-5, []
    for k in range(3):
        # The expected number of a change is the slope of the logarithm of the sum of all weights.
        up, down = moves.copy(), moves.copy()
        up[k] += step
        down[k] -= step
        numeric.append((log_sum(unary, first, up) - log_sum(unary, first, down)) / (2 * step))
    assert np.allclose(toxicity._move_marginals(unary, first, moves, forward, back), numeric, atol=1e-4)


def log_sum(unary, first, moves):
    total, state = 0.0, None
    for u, f in zip(unary, first):
        if f:
            total += np.log(state.sum()) if state is not None else 0.0
            state = np.array([1.0, np.exp(u)])
        else:
            state = np.array([state[0] + state[1] * np.exp(moves[1]), (state[0] * np.exp(moves[0]) + state[1] * np.exp(moves[2])) * np.exp(u)])
    return total + np.log(state.sum())


def toxic_rows():
    rng = random.Random(6)
    plain, bad = ["wo%d" % i for i in range(300)], ["vile%s" % x for x in "abcdefgh"]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=rng.choice([5, 40, 200]))
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark, documents):
    rows, labels = toxic_rows()
    more = [(1000, None), (1001, ""), (None, "so VILEzz, vileq"), (1002, "x " * 20_000), (1002, "x " * 20_000)]
    table = spark.createDataFrame([(i, None, y) for i, y in labels] + [(2000, None, 1), (None, None, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(rows + more)
    field = toxicity.learnt(docs, table)
    scored = {r.id: r for r in toxicity.scored(docs, field).collect()}
    wrong = [i for i, y in labels if (scored[i].score >= 0.5) != y]
    assert len(wrong) <= 2 and len(scored) == len(rows) + 4
    assert [tuple(s) for s in scored[None].spans] == [(3, 9), (11, 16)] or [tuple(s) for s in scored[None].spans] == [(3, 16)]
    assert scored[1000].score == scored[1001].score < 0.5 and not scored[1000].spans
    for i, text in rows:
        for a, b in scored[i].spans:
            assert "vile" in text[a:b].lower()
    kept = toxicity.without_toxic(docs, field)
    assert kept.columns == docs.columns
    assert kept.count() == sum(scored[i].score < 0.5 for i, _ in rows + more)
    nothing = toxicity.learnt(docs, table.limit(0))
    assert toxicity.scored(docs.limit(0), field).count() == 0
    assert toxicity.scored(docs, nothing).where("score >= 0.5").count() == 0
    assert toxicity.learnt(docs, table.where("toxic = 0")).weights == {}
    held = spark.createDataFrame([(5,), (None,)], "i bigint").select(toxicity.held_out(toxicity.F.col("i"))).collect()
    assert [r[0] for r in held] == [zlib.crc32(b"5") % 5 == 0, True]


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """All stages over 200 documents against their plain versions, the learnt scores taken as given."""
    folder = "/root/testdata/sf0.001"
    placed = corpus_pipeline.run(spark, folder).collect()
    check_places(placed)
    docs = queries.table(spark, folder, "documents")
    field = toxicity.learnt(docs, queries.table(spark, folder, "labels"))
    texts = {r.doc_id: r.text for r in toxicity.without_toxic(docs, field).collect()}
    newest = {}
    for i in sorted(texts):
        newest["".join(c.lower() if "A" <= c <= "Z" else c for c in texts[i])] = i
    texts = {i: texts[i] for i in newest.values()}
    ids = sorted(texts)
    prints = {i: simhash.simhash(texts[i].encode()) % 2**64 for i in ids}
    group = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                x, y = sorted((group[a], group[b]))
                group = {i: x if g == y else g for i, g in group.items()}
    texts = {i: texts[i] for i in ids if group[i] == i}
    items = [tuple(r) for r in queries.table(spark, folder, "benchmark").select("item_id", "text").collect()]
    from test_documents import brute_matches

    dirty = {r[0] for r in brute_matches(sorted(texts.items()), items)}
    assert {r.doc_id for r in placed} == set(texts) - dirty
