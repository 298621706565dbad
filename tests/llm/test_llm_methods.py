"""The methods by themselves: exact codes, trees, chains, weights, and plans."""

import heapq
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tonegauge.llm import decontamination, huffman, language_model, ngram_join, packing, passages, pii, quality, toxicity
from tonegauge.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_huffman(counts):
    heap = [(int(c), i) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    total, names = 0, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        names += 1
        heapq.heappush(heap, (a[0] + b[0], names))
    return total


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_code_lengths_are_optimal_and_limited(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 20).astype(int)
    used = counts > 0
    assert (lengths[~used] == 0).all()
    if used.sum() > 1:
        assert (lengths * counts).sum() == plain_huffman(counts)
        assert math.isclose((0.5 ** lengths[used]).sum(), 1)
        short = huffman.code_lengths(counts, 8).astype(int)
        assert short.max() <= 8 and math.isclose((0.5 ** short[used]).sum(), 1)
        assert (short * counts).sum() >= (lengths * counts).sum()


def test_limit_too_small():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, int), 2)


@given(st.lists(st.lists(st.integers(0, 40), max_size=700), min_size=1, max_size=5))
@settings(max_examples=40, deadline=None)
def test_blocks_round_trip(docs):
    parts = [np.array(d, np.uint32) for d in docs]
    code = huffman.Code(huffman.code_lengths(np.bincount(np.concatenate(parts), minlength=41) if sum(map(len, parts))
                                             else np.ones(41, int)))
    raw = huffman.write_block(code, list(range(len(parts))), parts, 7)
    (keys, sizes, before, ids), = huffman.read_blocks(code, raw + b"\n")
    assert before == 7 and keys.tolist() == list(range(len(parts))) and sizes.tolist() == list(map(len, parts))
    assert (ids == np.concatenate(parts)).all()
    if len(raw) > 60:
        broken = bytearray(raw)
        broken[50] ^= 1
        with pytest.raises(ValueError):
            list(huffman.read_blocks(code, bytes(broken) + b"\n"))


@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes), 100)
    room, expected = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(100)
        expected[i] = (at, 100 - room[at])
        room[at] -= sizes[i]
    assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [expected[i] for i in range(len(sizes))]


@given(st.integers(0, 10_000))
@settings(max_examples=30, deadline=None)
def test_signature_tree_loses_no_link(seed):
    rng = random.Random(seed)
    n, base = rng.randint(2, 120), [rng.sample(range(10_000), rng.randint(1, 60)) for _ in range(4)]
    sets = []
    for _ in range(n):
        own = set(rng.choice(base))
        own -= set(rng.sample(sorted(own), len(own) * rng.randint(0, 3) // 10))
        own |= set(rng.sample(range(10_000), rng.randint(0, 6)))
        sets.append(np.unique([ngram_join.xxhash.xxh3_64_intdigest(str(x)) for x in own or {1}]).astype(np.uint64))
    labels = np.array([rng.randint(0, n) for _ in range(n)])
    maps = np.stack([np.frombuffer(ngram_join.signature(s), np.uint8) for s in sets])
    tree = ngram_join.SignatureTree(np.arange(n), np.array([len(s) for s in sets]), labels, maps)
    got = {frozenset((int(tree.ids[i]), int(tree.ids[j]))) for i, j in tree.pairs()}
    for i in range(n):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if labels[i] != labels[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert frozenset((i, j)) in got


def test_join_finds_links_that_leaders_miss(spark, monkeypatch):
    """Chains of neighbours: each links with the next only, so components are long paths."""
    import brute

    rng = random.Random(1)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(900)]
    docs = [(i, " ".join(words[i * 8:i * 8 + 100])) for i in range(100)] + [(500 + i, " ".join(words[3:120 - i])) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    # Without leaders, with leaf-sized cells, trees of many nodes, and large keys cut into blocks.
    for rounds, leaf, block in ((0, 32, 8192), (2, 32, 8192), (0, 2, 5)):
        monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
        monkeypatch.setattr(ngram_join, "LEAF", leaf)
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        got = sorted(map(tuple, ngram_join.link(df).select("doc_id", "n_shingles", "component_id").collect()))
        assert got == brute.components(sorted(docs))


@given(st.integers(0, 10_000))
@settings(max_examples=30, deadline=None)
def test_leaves_at_once_equal_trees(seed):
    """Many small cells together give what a tree for each gives, each pair at its smallest shared key only."""
    rng = np.random.default_rng(seed)
    cells = [int(c) for c in rng.integers(1, ngram_join.LEAF + 1, 6)]
    n, key = sum(cells), 1_000
    base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    sets = [np.unique(rng.choice(base, 30)) for _ in range(n)]
    maps = np.stack([np.frombuffer(ngram_join.signature(s), np.uint8) for s in sets])
    sizes, labels = np.array([len(s) for s in sets]), rng.integers(0, 5, n)
    sides = np.repeat(rng.integers(0, 2, 6), cells) * rng.integers(0, 2, n)
    firsts = np.sort(rng.integers(0, 4_000, (n, ngram_join.FIRSTS)), 1)
    cell = np.repeat(np.arange(6), cells)
    ids = np.arange(n)
    got = set()
    for a, b in ngram_join.leaf_pairs(cell, np.full(n, key), ids, sizes, labels, sides, firsts, maps):
        got |= set(zip(a.tolist(), b.tolist()))
    expected = set()
    for c in range(6):
        at = cell == c
        tree = ngram_join.SignatureTree(ids[at], sizes[at], labels[at], maps[at], sides[at], firsts[at], key)
        pairs = [sorted((int(tree.ids[i]), int(tree.ids[j]))) for i, j in tree.pairs()]
        expected |= {tuple(p) for p in pairs}
        assert not any(set(firsts[a][firsts[a] < key]) & set(firsts[b]) for a, b in pairs)
    assert got == expected


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
@settings(max_examples=60, deadline=None)
def test_best_chain(points):
    x, y = (np.array(c) for c in zip(*points))
    order = sorted(range(len(points)), key=lambda i: points[i])
    best = {}
    for j in order:
        best[j] = 8.0 + max([0.0] + [best[i] - 0.1 * (x[j] - x[i] + y[j] - y[i])
                                     for i in best if x[i] < x[j] and y[i] < y[j]])
    first = passages.chains(x, y)[0]
    assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(first, first[1:]))
    score = 8.0 * len(first) - 0.1 * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(first, first[1:]))
    assert math.isclose(score, max(best.values()))
    used = sorted(i for c in passages.chains(x, y) for i in c)
    assert used == list(range(len(points)))


def test_alignment_counts_words_and_extends():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    b = np.concatenate([a[:50], rng.integers(0, 1 << 60, 2).astype(np.uint64), a[53:150]])
    s, e, t, f, n = passages.align(a, b, np.array([10, 80]), np.array([10, 79]))
    assert (s, e, t, f, n) == (0, 150, 0, 149, 147)
    found, at = passages.seeds(a)
    assert len(at) and np.diff(at).max() <= passages.WINDOW


def test_passages_around_a_differing_middle_are_kept(spark):
    rng = np.random.default_rng(1)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1 << 40, n)]

    rows, expected = [], set()
    for key, (first, gap, second) in enumerate([(60, 10, 60), (60, 50, 60), (60, 120, 60), (60, 300, 60), (45, 90, 150)]):
        head, tail = words(first), words(second)
        rows += [(2 * key + i, " ".join(head + words(gap + 7 * i) + tail)) for i in (0, 1)]
        # brute force: the whole if it is alike, or else either passage
        if first + second >= 0.75 * (first + gap + 7 + second):
            expected.add((2 * key, 0, first + gap + second))
        else:
            expected |= {(2 * key, 0, first), (2 * key, first + gap, first + gap + second)}
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sides = {(r["doc_id"], r["start_word"], r["end_word"]) for r in found} | {
        (r["other_doc_id"], r["other_start"], r["other_end"]) for r in found}
    assert expected <= sides and len(found) == len(expected)


def test_passages_of_frequent_lines_are_found(spark):
    rng = np.random.default_rng(2)
    lines = [[f"w{i}" for i in rng.integers(0, 1 << 40, 30)] for _ in range(50)]

    def filler(n):
        return [f"w{i}" for i in rng.integers(0, 1 << 40, n)]

    texts = []
    for _ in range(400):  # frequent lines, none next to another
        texts.append([w for i in rng.permutation(50)[:8] for w in lines[i] + filler(12)])
    for pair in range(30):  # a passage of two lines, or of one and the words after it
        one, two = rng.permutation(50)[:2]
        passage = lines[one] + lines[two] if pair % 2 else lines[one] + filler(10)
        texts += [filler(25) + passage + filler(25) for _ in range(2)]
    for _ in range(40):  # a passage that many have, within a line that more have
        texts.append(filler(20) + lines[0] + lines[1][:12] + filler(20))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = {frozenset((r["doc_id"], r["other_doc_id"])) for r in found}
    assert all(frozenset((400 + 2 * i, 401 + 2 * i)) in linked for i in range(30))
    assert {i for i in range(460, 500)} <= {i for p in linked for i in p}


def edited(rng, words, rule):
    """The words with every n-th replaced, or a share of them replaced, dropped or added."""
    out = []
    for i, w in enumerate(words):
        new = f"e{rng.integers(0, 1 << 40)}"
        if rule >= 1:
            out += [new] if i % rule == rule - 1 else [w]
        elif rng.random() < rule:
            out += [[new], [], [w, new]][rng.integers(0, 3)]
        else:
            out.append(w)
    return out


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for w in a:
        old, row = row, [0]
        for j, v in enumerate(b):
            row.append(old[j] + 1 if v == w else max(old[j + 1], row[j]))
    return row[-1]


def test_recall_of_edited_passages(spark):
    rng = np.random.default_rng(3)
    rows, promised, rules = [], {}, [10, 6, 0.05, 0.1, 0.15]
    for key in range(150):
        size, rule = int(rng.integers(50, 90)), rules[key % len(rules)]
        first = [f"p{i}" for i in rng.integers(0, 1 << 40, size)]
        second = edited(rng, first, rule)
        if longest_common(first, second) >= 0.78 * max(len(first), len(second)):  # brute force
            promised[key] = rule
        for i, body in enumerate((first, second)):
            around = [[f"f{i}" for i in rng.integers(0, 1 << 40, 30)] for _ in "ab"]
            rows.append((2 * key + i, " ".join(around[0] + body + around[1])))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = {min(r["doc_id"], r["other_doc_id"]) // 2 for r in found}
    by_rule = {r: np.mean([k in linked for k, v in promised.items() if v == r]) for r in rules}
    assert len(promised) > 120 and min(by_rule.values()) >= 0.95, by_rule


def test_extension_follows_edits_past_the_margin(spark):
    rng = np.random.default_rng(4)
    first = [f"p{i}" for i in rng.integers(0, 1 << 40, 400)]
    second = first[:7] + [w for i, w in enumerate(first[7:]) if i % 5 != 4]  # no seed past the start
    rows = [(0, "x " + " ".join(first) + " y"), (1, "z " + " ".join(second) + " v")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["start_word"], r["end_word"]) for r in found if r["doc_id"] == 0] + [
        (r["other_start"], r["other_end"]) for r in found if r["other_doc_id"] == 0] == [(1, 401)]


def test_stretches_of_one_word_meet_at_few_places(spark):
    sizes = [60 + 20 * i for i in range(12)]
    rows = [(i, " ".join([f"a{i}"] * 20 + ["then"] * n + [f"b{i}"] * 20)) for i, n in enumerate(sizes)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = {i: set() for i in range(12)}
    for r in found:
        covered[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
        covered[r["other_doc_id"]] |= set(range(r["other_start"], r["other_end"]))
    assert all(covered[i] >= set(range(20, 20 + n)) for i, n in enumerate(sizes))
    per_pair = Counter(frozenset((r["doc_id"], r["other_doc_id"])) for r in found)
    assert max(per_pair.values()) <= 2 + max(sizes) // passages.STRETCH


def test_a_sub_chain_goes_on_past_a_stray_match():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 1 << 30, 300).astype(np.uint32) for _ in "ab")
    b[60:110] = a[40:90]
    x, y = np.array([50, 51, 70]), np.array([70, 71, 160])  # the third is off the way of the others
    assert (40, 90, 60, 110, 50) in passages.alike(a, b, x, y)[0]


def test_quick_chains_equal_chains():
    rng, seen = random.Random(6), 0
    for turn in range(600):
        n, most = rng.randrange(1, 25), rng.choice([30, 60, 400])
        points = sorted(zip(*(sorted(rng.sample(range(most), n)) for _ in "xy")))
        if turn % 3 == 0:
            points = sorted({(rng.randrange(most), rng.randrange(most)) for _ in range(n)})
        x, y = (np.array(c) for c in zip(*points))
        ends, hard = passages.quick_chains(np.zeros(len(x), int), x, y)
        if not hard.any():
            seen += 1
            got = np.split(np.arange(len(x)), np.flatnonzero(ends)[:-1] + 1)
            assert sorted(map(list, got)) == sorted(passages.chains(x, y, 80, 1))
    assert seen > 200


def test_no_extension_ends_beyond_its_bound():
    rng, n = random.Random(7), passages.REACH
    for _ in range(400):
        a = [rng.randrange(6) for _ in range(60)]
        b = [w if rng.random() < 0.8 else rng.randrange(6) for w in a if rng.random() < 0.97]
        far_a, far_b, alive = passages.reach_bound(np.array([a[:n]]), np.array([b[:n]]))
        i, j, *_ = passages._reach(a, b)
        assert alive[0] or far_a[0] >= i and far_b[0] >= j


def test_a_passage_is_reported_once(spark):
    line = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join([f"f{i}{j}" for j in range(20)] + line * (30 + i))) for i in (0, 1)]
    found = [tuple(r) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
             .select("start_word", "end_word", "other_start", "other_end").collect()]
    assert found and not any(a != b and a[0] >= b[0] and a[1] <= b[1] and a[2] >= b[2] and a[3] <= b[3]
                             for a in found for b in found) and len(set(found)) == len(found)


def test_mixture_weights_follow_the_better_estimate():
    rows = [(3, -4, -40, 90), (3, language_model.NEVER, -20, 10), (0, language_model.NEVER, -8, 50)]
    by_bucket, _ = language_model.weights_from(rows, 1e-6, 2)
    assert by_bucket[3][0] > 0.8 and by_bucket[0][1] > 0.9
    assert all(math.isclose(sum(w), 1) for w in by_bucket.values())


def test_expectation_maximisation_finds_planted_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    votes = np.zeros((len(good), 5))
    for j, right in enumerate((0.95, 0.9, 0.8, 0.7, 0.6)):
        said = np.where(rng.random(len(good)) < right, good, ~good) * 2 - 1
        votes[:, j] = np.where(rng.random(len(good)) < 0.9, said, 0)
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_counts(list("abcde"), kinds, counts.astype(float))
    assert abs(model.prior - 0.7) < 0.03
    for name, right in zip("abcde", (0.95, 0.9, 0.8, 0.7, 0.6)):
        assert abs(model.accuracy(name) - right) < 0.04


def test_ordinal_thresholds_are_in_order():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(600)]
    score = np.array([np.isin(r, [0, 1]).sum() * 2 + np.isin(r, [2]).sum() for r in rows])
    grades = np.clip(score // 2, 0, 2) + (score > 4)
    w, cuts = toxicity.fit_ordinal(rows, grades, 6)
    assert (np.diff(cuts) > 0).all() and min(w[0], w[1]) > w[2] > max(w[3:])


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"))
    rows = toxicity.score(docs, model).join(labels.where("doc_id % 4 = 0").withColumnRenamed("toxic", "y"), "doc_id")
    got = rows.select("y", "toxic").collect()
    assert sum(r["y"] == r["toxic"] for r in got) >= 0.93 * len(got)


def test_held_out_language_model(spark):
    rows = language_model.score(table(spark, SF, "documents")).collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_run_no_python(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    for df in (decontamination.contamination(docs, bench), decontamination.remove_documents(docs, bench),
               decontamination.remove_spans(docs, bench), docs.select(pii.find_spans(docs)), pii.redact(docs)):
        assert not any(word in plan(df) for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_windows_are_looked_up_in_a_broadcast(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert "BroadcastHashJoin" in plan(decontamination.contamination(docs, bench))
