import hashlib
import re
from collections import Counter

import numpy as np
import pytest

import tallyloom.llm.suffix_dedup as suffix_dedup
from tallyloom.llm.common import connected_components, local_components
from tallyloom.llm.embedding_dedup import near_duplicate_vectors, table_plan
from tallyloom.llm.minhash_forest import near_duplicate_texts
from tallyloom.llm.suffixes import common_prefixes, suffix_array

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def text_groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    links = []
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return sets, groups(ids, links)


def removal(rows, length=200):
    texts = {i: (t or "").encode() for i, t in rows}
    count = Counter(b[s : s + length] for b in texts.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in texts.items():
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(205, 201), (203, 205), (201, 203), (7, 7)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for p in links for x in p}
    assert found == {i: c for i, c in groups(ids, links).items() if i != c}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_components_reach_the_smallest_position():
    assert local_components(6, np.array([5, 2, 4]), np.array([2, 4, 3])).tolist() == [0, 1, 2, 2, 2, 2]


@pytest.mark.parametrize("rows", [1, 10_000, 10**9])
def test_enough_sign_tables_for_any_number_of_rows(rows):
    bits, tables = table_plan(rows, 0.95, 0.999)
    assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables >= 0.999


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    near = np.vstack([base, base[:20] + 0.05 * rng.standard_normal((20, 16)), np.repeat(base[3:4], 30, axis=0)]).astype(np.float32)
    rows = [(int(i), v.tolist(), None, "x") for i, v in enumerate(near)]
    rows += [(900, None, 1, "x"), (901, [0.0] * 16, 1, "x"), (902, [float("nan")] * 16, 1, "x"), (903, [], 1, "x"), (None, [1.0] * 16, 1, "x")]
    rows += [(904, [1.0, None] * 8, 1, "x"), (905, [1.0, 0.0, 2.0], 1, "x")]
    found = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep int, weight string"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    unit = near.astype(float) / np.linalg.norm(near.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    component = groups(range(len(near)), zip(*np.nonzero(linked)))
    for i in range(len(near)):
        assert got[i] == (linked[i].sum(), component[i], component[i] == i)
    for i in (900, 901, 902, 903, 904, 905):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, True)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(empty).count() == 0


def test_a_bucket_over_the_block_size_is_dealt_out(spark, monkeypatch):
    import tallyloom.llm.embedding_dedup as module

    monkeypatch.setattr(module, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist()) for i in range(150)]
    found = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {(r.n_links, r.component_id) for r in found.collect()} == {(149, 0)}


@pytest.mark.parametrize("width", [2, 5])
def test_near_texts_equal_brute_force(spark, width):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets, component = text_groups(rows, width, 80)
    got = near_duplicate_texts(docs, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), component[i], component[i] == i) for i, _ in rows
    }


def test_near_texts_with_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Word"), (5, "word"), (6, long), (7, long + " end"), (None, long), (8, "a b"), (8, "a b")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, size int")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicate_texts(df, width=2).collect()}
    assert got == {
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 59_999, 6, True),
        (7, 60_000, 6, False), (None, 59_999, 6, True), (8, 1, 8, True),
    }
    assert near_duplicate_texts(df.limit(0)).count() == 0


def test_rows_that_share_an_id_link_their_texts(spark):
    one, two = " ".join("abcdefghijklmnopqrstuvwxyz"), " ".join(map(str, range(30)))
    rows = [(1, one), (8, one + " aa"), (8, two + " 30"), (9, two), (8, ""), (10, "all else is here"), (None, one)]
    # Repeated rows of one text stand for one class.
    rows += [(7, "x y z")] * 50 + [(7, "u v w")]
    got = near_duplicate_texts(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert len(got) == len(rows)
    places = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert places == {
        (1, 25): 1, (8, 26): 1, (8, 30): 1, (9, 29): 1, (8, 0): 8, (10, 3): 10, (None, 25): 1, (7, 2): 7
    }


@pytest.mark.parametrize("largest", [8_192, 115, 0])
def test_dense_regions_are_compared_beyond_the_window(spark, monkeypatch, largest):
    import tallyloom.llm.minhash_forest as module

    monkeypatch.setattr(module, "REGION_BLOCK", 16)
    monkeypatch.setattr(module, "LARGE_SET", largest)
    rng = np.random.default_rng(2)
    words = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(words)
        for at in rng.integers(0, 120, 4):
            own[at] = f"x{i}_{at}"
        rows.append((i, " ".join(own)))
    _, component = text_groups(rows, 1, 80)
    got = near_duplicate_texts(spark.createDataFrame(rows, "doc_id long, text string"), width=1)
    assert {r.doc_id: r.component_id for r in got.collect()} == component


@pytest.mark.parametrize("data", [b"", b"a", b"banana", b"\0\0\0", b"ab\0\0ab\0", b"abcabc" * 40])
def test_suffix_arrays(data):
    order = suffix_array(np.frombuffer(data, np.uint8))
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_common_prefixes_stop_at_the_ends_of_pieces():
    rng = np.random.default_rng(0)
    pieces = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (30, 5, 44, 1, 80)]
    starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    kept, shared = common_prefixes(data, starts, np.array([len(p) for p in pieces]), suffix_array(data), 6)
    text = data.tobytes()
    legal = [s + i for s, p in zip(starts, pieces) for i in range(len(p) - 5)]
    assert sorted(kept.tolist()) == legal
    for n, (a, b) in enumerate(zip(kept[:-1], kept[1:])):
        size = next((i for i in range(6) if text[a + i] != text[b + i]), 6)
        assert shared[n + 1] == size


@pytest.mark.parametrize("shard", [suffix_dedup.SHARD_BYTES, 600])
def test_removal_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_dedup.removal_report(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removal(rows)


def test_removal_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    passage = "".join(map(chr, rng.integers(200, 400, 150)))
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "b" * 201), (5, "short"), (6, passage + "tail"), (7, "head" + passage), (8, "c" * 3_000 + "d")]
    rows += [(9, "".join(map(chr, rng.integers(97, 123, 2_200_000))))]
    rows += [(10, rows[-1][1][:300])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, tag string, lo int")
    got = suffix_dedup.removal_report(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removal(rows)
    twice = spark.createDataFrame([(1, passage), (1, passage), (None, passage)], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.removal_report(twice).collect()] == [300] * 3
    cut = suffix_dedup.without_repeats(df).orderBy("doc_id")
    assert cut.columns == df.columns and [r.text for r in cut.collect()][5:7] == ["tail", "head"]
    assert suffix_dedup.removal_report(df.limit(0)).count() == 0
