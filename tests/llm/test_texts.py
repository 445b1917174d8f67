import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import quality_votes, source_mix
from tallyloom.llm.chat_trees import chat_conversations, escaped, linear_threads, read_back, reply_paths, unescaped
from tallyloom.llm.curve_search import curve_neighbours
from tallyloom.llm.hilbert import hilbert_keys
from tallyloom.llm.packing import Encoder, packed_pieces, packing_slots
from tallyloom.llm.quality_votes import good_documents, quality_scores
from tallyloom.llm.source_mix import mix_report, mixed_documents, permuted
from tallyloom.llm.toxicity import toxicity_scores
from tallyloom.llm.warc_archive import BrokenArchive, archive_records, archive_round_trip, payload_digest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, y int"
LONG = " ".join(f"word{i}" for i in range(20_000))
ODD = [
    (1, None, None, None, None, "x", 1, 1), (2, "", "en", "a", 0, "x", 1, 1), (3, " \t", "en", "a", 2, "x", 1, 1),
    (4, "one  two <|endoftext|> ", "en", "b", 5, None, None, None), (5, LONG, "en", "c", 9, "x", 1, 1), (6, LONG, None, None, 9, "x", 1, 1),
    (None, "no id", "en", "a", 5, "x", 1, 1), (7, "same row", "en", "a", 5, "x", 1, 1), (7, "same row", "en", "a", 5, "x", 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.mark.parametrize("text", ["", "\\", "\\h", "###", "####", "</turn>", "</tur</turn>n>", "\\\\b:###\\e", "a: b\n### user: x</turn>\n", "é😀"])
def test_escapes_are_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).first()
    assert row.u == text and "###" not in row.e and "</turn>" not in row.e


def test_reply_trees_give_all_paths_and_the_best_branch(spark):
    nodes = [("t", n, p, s) for n, p, s in [(1, None, 0.0), (2, 1, 1.0), (3, 1, 5.0), (4, 2, 1.0), (5, 3, 0.0), (6, 5, 9.0)]]
    nodes += [("t", 20, 21, 0.0), ("t", 21, 20, 0.0), ("t", 22, 21, 0.0), ("u", 1, 99, None)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    paths = defaultdict(list)
    for r in reply_paths(df).orderBy("depth").collect():
        paths[r.tree, r.leaf].append(r.node)
    assert paths == {("t", 4): [1, 2, 4], ("t", 6): [1, 3, 5, 6], ("u", 1): [1]}
    messages = df.withColumn("role", F.lit("assistant")).withColumn("text", F.col("node").cast("string"))
    best = {r.tree: [t.text for t in r.turns] for r in read_back(chat_conversations(messages)).collect()}
    assert best == {"t": ["1", "3", "5", "6"], "u": ["1"]}
    assert chat_conversations(messages, branches=None).count() == 3


def test_threads_read_back_what_was_said(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, 3, "assistant", "a</turn>\n### user: "), (1, 4, "assistant", ""), (None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    rows += [(2, i, "assistant", f"{i} 😀") for i in range(70)]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], "conv_id long, turn long, role string, text string, node int, tree string")
    got = {r.tree.conv_id: r for r in read_back(chat_conversations(linear_threads(df))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", ""), ("", "x"), ("", "x"), ("assistant", rows[3][3]), ("assistant", "")]
    assert got[1].loss_texts == [rows[3][3], ""] and got[2].loss_texts == [f"{i} 😀" for i in range(70)] and set(got) == {1, 2, None}
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "lost"), ("assistant", "found")]
    assert chat_conversations(linear_threads(df.limit(0))).count() == 0


def test_archives_return_every_page(spark):
    pages = [(1, "u", "same"), (2, None, "same"), (3, "u\r\nX: y", None), (4, "u", ""), (None, "u", "same"), (5, "u", LONG * 3), (6, "u", "own é")]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, archive int, frame string")
    got = {r.page_id: r for r in archive_round_trip(df).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), None: ("revisit", 2),
        5: ("response", None), 6: ("response", None),
    }
    for i, _, html in pages:
        assert (got[i].payload_bytes, got[i].payload_digest) == (len((html or "").encode()), payload_digest((html or "").encode()))
    assert archive_round_trip(df, least_bytes=5).where("record_type = 'revisit'").count() == 0
    assert archive_round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("content", [b"abcd", b"P*M\x18\0\0\0\0", b"]*M\x18\x09\0\0\0x", b"]*M\x18\0\0\0\0\x28\xb5\x2f\xfd\x04"])
def test_broken_archives_are_refused(content):
    with pytest.raises(BrokenArchive):
        list(archive_records(content))


def test_scores_on_held_out_rows(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for found, label, least in ((quality_scores(docs, known), "quality", 0.95), (toxicity_scores(docs, known), "toxic", 0.9)):
        rows = found.where("held_out").join(known, "doc_id").collect()
        assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_scores_of_odd_rows(odd, labels):
    for found in (quality_scores(odd, labels), toxicity_scores(odd, labels), quality_scores(odd, labels.limit(0)), toxicity_scores(odd, labels.limit(0))):
        rows = found.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality_scores(odd.limit(0), labels).count() == toxicity_scores(odd.limit(0), labels).count() == 0
    assert good_documents(odd, labels).columns == odd.columns


def test_words_are_encoded_like_whole_texts(spark):
    encoder = Encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["", " ", "a ", "a\n b", "a\n\n b", "a \n b", "a  b", "it's 3 o'clock", "x<|endoftext|>y", "  a", " lead", "tab\t tab \t"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids


def test_packing_of_odd_rows(odd):
    encoder = Encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    rows = packed_pieces(odd).collect()
    held, by = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text in ((r[0], r[1]) for r in ODD if r[0] != 7):
        ids = np.append(np.frombuffer(encoder.encode(text or ""), np.uint32), np.uint32(0))
        for r in by[doc_id]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert sum(r.length for r in by[doc_id]) == len(ids)
    assert len(by[7]) == 2 and packed_pieces(odd.limit(0)).count() == 0


def test_slots_take_every_piece_and_leave_little_padding():
    rng = np.random.default_rng(0)
    histogram = {int(v): int(n) for v, n in zip(*np.unique(rng.integers(1, 1024, 4_000), return_counts=True))} | {700: 3_000}
    slots = packing_slots(histogram)
    assert slots.groupby("length")["count"].sum().to_dict() == histogram
    used = sum(v * n for v, n in histogram.items())
    balanced = {v: n for v, n in histogram.items() if v != 700}
    full = packing_slots(balanced)
    assert full["sequence"].add(full["count"]).max() * 1024 <= 1.03 * sum(v * n for v, n in balanced.items())
    assert slots["sequence"].add(slots["count"]).max() * 1024 >= used and len(packing_slots({})) == 0


@pytest.mark.parametrize("bits, axes", [(4, 2), (3, 3), (2, 4)])
def test_curves_step_to_a_neighbouring_cell(bits, axes):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), axis=-1).reshape(-1, axes)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_search_finds_nine_tenths_of_the_true_neighbours(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.orderBy("vec_id").collect()
    table = np.array([r.embedding for r in rows], float)
    got = defaultdict(list)
    for r in curve_neighbours(vectors, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hits = []
    for q in range(0, len(table), 20):
        order = np.lexsort((np.arange(len(table)), -(table @ table[q])))
        hits.append(len(set(order[order != q][:20]) & set(got[q])) / 20)
    assert np.mean(hits) >= 0.9


def test_search_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [2.0, 1.0]), (3, [2.0, 0.0]), (4, [2.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (40, [1.0]), (3, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, dim int, query string")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in curve_neighbours(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 2.0), (0, 2, 4, 2.0), (0, 3, 20, 2.0), (20, 1, 3, 4.0), (20, 2, 4, 4.0), (20, 3, 0, 2.0)]
    assert curve_neighbours(df.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 64, 100, 1_023, 4_096])
def test_permutations_are_one_to_one(spark, count):
    rows = spark.range(count).select(permuted(F.col("id"), F.lit(count).cast("bigint"), F.lit(13)).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(count))


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(300, "a"), (90_000, "b"), (60_000, "c"), (900, "d"), (0, "e"), (2_000, None)])]
    got = mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    targets = {r.doc_id: r.target for r in got}
    rest = 153_200 - 900 - 2_700 - 6_000
    level = rest / 3
    assert targets[0] == 900 and targets[3] == 2_700 and targets[4] == 0 and targets[5] == 6_000
    assert targets[1] == pytest.approx(2 * level) and targets[2] == pytest.approx(level)
    for r in got:
        assert r.taken <= 3 * r.size and abs(r.taken - r.target) <= 0.02 * r.target + 128


def test_mix_of_odd_rows(odd):
    rows = mix_report(odd).collect()
    assert len(rows) == len(ODD) and {r.doc_id: r["size"] for r in rows}[5] == 20_000
    assert all(r.taken <= 3 * r["size"] for r in rows)
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    texts = mixed.collect()
    assert sum(len(r.text.split()) for r in texts) == sum(r.taken for r in rows) and all(r.n_chars == len(r.text) for r in texts)
    assert sum(r.doc_id is None for r in texts) == 3 * (sum(r.taken for r in rows if r.doc_id is None) > 0) or any(r.doc_id is None for r in texts)
    assert mix_report(odd.limit(0)).count() == 0 and mixed_documents(odd.limit(0)).count() == 0


def test_repeated_and_null_ids_are_taken_within_their_limit(spark):
    rows = [(100, f"w{i} " * 500, "a") for i in range(5)] + [(None, f"v{i} " * 300, "a") for i in range(5)]
    rows += [(200 + i, "x y z " * 400, "b") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_report(df).collect()
    assert len(got) == 30 and all(0 <= r.taken <= 3 * r["size"] for r in got)
    by_source = {s: sum(r.taken for r in got if r.source_size == s) for s in (4_000, 24_000)}
    assert {r.target for r in got} == {12_000.0, 16_000.0} and all(abs(t - w) < 128 for t, w in zip(by_source.values(), (12_000, 16_000)))
    texts = [r.text.split() for r in mixed_documents(df).collect()]
    assert sum(map(len, texts)) == sum(r.taken for r in got)
    assert {w for t in texts for w in t if w[0] == "v"} == {f"v{i}" for i in range(5)}


def test_taken_words_equal_a_walk_over_all_slots(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "SHARD_SLOTS", 16)
    rng = np.random.default_rng(2)
    rows = [(i, f"s{i % 5}" if i % 5 else None, int(n)) for i, n in enumerate(rng.integers(0, 900, 120))]
    df = spark.createDataFrame(rows, "row long, source string, size long")
    plan, _, total = source_mix.source_plan(df, source_mix.WEIGHTS)
    plans = {r.ordinal: r for r in plan.collect()}
    slots = source_mix.drawn_slots(plan, total, 13).collect()
    pieces = source_mix.placed_pieces(df, plan)[0].collect()
    # Pieces tile every row and every block; each epoch takes a block once, and shards are full.
    for i, _, size in rows:
        mine = sorted((p.first, p.last) for p in pieces if p.row == i)
        assert [a for a, _ in mine] + [size] * (size > 0) == [0] * (size > 0) + [b for _, b in mine]
    assert len({(s.ordinal, s.block, s.epoch) for s in slots}) == len(slots) == sum(p.quota for p in plans.values())
    assert len({(s.shard, s.place) for s in slots}) == len(slots) and max(s.shard for s in slots) == (len(slots) - 1) // 16
    assert all(0 <= s.block < plans[s.ordinal].blocks and 0 <= s.epoch < 3 for s in slots)
    taken = defaultdict(int)
    for s in slots:
        for p in pieces:
            if (p.ordinal, p.block) == (s.ordinal, s.block):
                taken[p.row] += p.last - p.first
    told = df.select(F.col("row").alias("doc_id"), "source", F.repeat(F.lit("w "), F.col("size").cast("int")).alias("text"))
    got = mix_report(told).collect()
    for o, p in plans.items():
        mine = [r for r in got if r.source_size == p.source_size and r.target == p.target]
        assert abs(sum(r.taken for r in mine) - p.target) <= 3 * 64
    assert sum(r.taken for r in got) == pytest.approx(sum(taken.values()), abs=3 * 64 * len(plans))
    pieces_of, _ = source_mix.mixed_pieces(df, source_mix.WEIGHTS, 13)
    assert {r.row: r.n for r in pieces_of.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("n")).collect()} == dict(taken)
    # Sources' shares differ from shard to shard, as drawn ones do.
    counts = defaultdict(set)
    for shard in {s.shard for s in slots}:
        counts[0].add(sum(s.ordinal == 0 for s in slots if s.shard == shard))
    assert len(counts[0]) > 2


def test_slots_do_not_repeat_the_steps_of_their_permutation(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], 100 + 37 * i) for i in range(40)], "row long, source string, size long")
    pieces, plan = source_mix.mixed_pieces(df, source_mix.WEIGHTS, 13)
    planned = pieces.select("row", "first", "last", "epoch")._jdf.queryExecution().optimizedPlan().toString()
    assert planned.count("xxhash64") <= 3 and planned.count("CASE WHEN") <= 3
    total = sum(r.quota for r in plan.collect())
    slots = source_mix.drawn_slots(plan, total, 13)
    own = F.col("slot") - F.col("first_slot")
    told = spark.range(total).withColumnRenamed("id", "slot").join(plan, (F.col("slot") >= F.col("first_slot")) & (own < F.col("quota")))
    told = told.withColumn("epoch", F.floor(own / F.col("blocks")))
    block = permuted(own % F.col("blocks"), F.col("blocks"), F.lit(13), F.col("ordinal"), F.col("epoch"))
    place = permuted(F.col("slot"), F.lit(total).cast("bigint"), F.lit(13))
    told = told.select(F.floor(place / 4_096), place % 4_096, "ordinal", block, "epoch")
    assert sorted(map(tuple, slots.collect())) == sorted(map(tuple, told.collect()))


def test_tied_neighbours_all_vote():
    space = quality_votes.Space(np.ones(quality_votes.TERMS, np.float32), np.eye(quality_votes.TERMS, 2, dtype=np.float32))
    vectors = np.repeat(np.array([[1.0, 0.0]], np.float32), 60, axis=0)
    good = np.arange(60) % 2.0
    counts = np.zeros((1, quality_votes.TERMS), int)
    counts[0, 0] = 3
    for order in (np.arange(60), np.arange(60)[::-1]):
        voters = quality_votes.Voters(space, vectors[order], good[order], np.ones(60), 0.1)
        assert voters.scores(counts).tolist() == [0.5]


def brute_votes(voters, counts):
    """Scores by plain loops over every labelled vector."""
    out = []
    for row in counts:
        latent = voters.space.latent(row[None])[0]
        near = sorted(((float(latent @ v), float(y), float(w)) for v, y, w in zip(voters.vectors, voters.good, voters.weights)), reverse=True)
        edge = near[min(quality_votes.NEIGHBOURS, len(near)) - 1][0]
        votes = [(s**quality_votes.SHARPNESS * w, y) for s, y, w in near if s >= edge and s > 0]
        total = sum(v for v, _ in votes)
        out.append(sum(v * y for v, y in votes) / total if total > 1e-9 else voters.prior)
    return out


def test_quality_scores_equal_plain_votes(spark, labels):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    usable = quality_votes.remainder(F.col("doc_id"), 4) != 2
    voters = quality_votes.fit_voters(docs, labels, usable)
    texts = {r.doc_id: r.text for r in docs.limit(40).collect()}
    data = [t.encode() for t in texts.values()]
    offsets = np.cumsum([0, *map(len, data)])
    counts = quality_votes.term_counts(np.frombuffer(b"".join(data), np.uint8), offsets)
    got = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    assert [got[i] for i in texts] == pytest.approx(brute_votes(voters, counts), abs=1e-3)
