"""Top-k search, conversation repair and spelling groups against brute force, with their edge cases."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import CLASHES, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonegauge.llm import conversations, spelling, vector_search

#: Columns that the three operators use inside.
MORE = ["v", "a", "b", "bound", "ring", "pivot", "distance", "shard", "times", "open", "part", "word", "form", "signature"]


def clashing(df):
    return df.select("*", *[F.lit(1).alias(c) for c in {*CLASHES, *MORE} - set(df.columns)])


# --- exact top-k search


def nearest(rows, k, every):
    whole = [(i, np.floor(256 * np.array(v))) for i, v in rows
             if i is not None and v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(whole):
        if i % every == 0:
            best = sorted((-int(v @ w), j) for n, (j, w) in enumerate(whole) if n != at)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return out


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(1)
    centres = 2 * rng.normal(size=(8, 6))
    near = lambda: [float(np.float32(x)) for x in centres[rng.integers(8)] + 0.1 * rng.normal(size=6)]
    rows = [(i, near()) for i in range(600)]
    rows += [(1000 + i, rows[100][1]) for i in range(60)] + [(100, rows[100][1])] * 2  # a hot vector, a repeated row
    rows += [(150, [0.0] * 6), (50, None), (None, rows[0][1]), (200, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (250, [float("nan")] * 6), (300, [float("inf")] * 6), (350, [1.0]), (400, []), (-50, [-0.0] * 6)]
    return rows


@pytest.mark.parametrize("shard,pivots,k,every", [(40, 8, 5, 50), (100_000, 3, 5, 50), (7, 64, 1, 25), (64, 1, 700, 200)])
def test_top_k(spark, vector_rows, shard, pivots, k, every):
    df = clashing(spark.createDataFrame(vector_rows, "vec_id long, embedding array<float>").repartition(4))
    got = vector_search.top_k(df, k=k, every=every, shard=shard, pivots=pivots)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == Counter(nearest(vector_rows, k, every))


def test_top_k_of_little(spark, vector_rows):
    df = spark.createDataFrame(vector_rows, "vec_id long, embedding array<float>")
    assert vector_search.top_k(df.limit(0)).count() == 0
    assert vector_search.top_k(df.where("embedding IS NULL")).count() == 0
    assert vector_search.top_k(df.where("vec_id = 0")).count() == 0
    zeros = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, 0.0]), (50, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, vector_search.top_k(zeros).collect())) == [(0, 1, 1, 0), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0)]


def test_bounds_leave_shards_out(spark):
    """Far-apart groups: queries ask for few of the shards."""
    rng = np.random.default_rng(2)
    points = np.floor(256 * (20 * np.eye(8)[rng.integers(8, size=400)] + 0.01 * rng.normal(size=(400, 8))))
    longest = float(np.sqrt((points ** 2).sum(1)).max())
    pivots = vector_search.choose_pivots(vector_search.lifted(points, longest), 8)
    near = vector_search.distances(vector_search.lifted(points, longest), pivots)
    shards = [vector_search.Shard(p, near[near.argmin(1) == p, p].min(), near[near.argmin(1) == p, p].max()) for p in range(8)]
    plan = vector_search.Directory(pivots, longest, {}, shards)
    scores = np.sort(points @ points.T, axis=1)[:, -6]
    far = vector_search.distances(np.column_stack([points, np.zeros(400)]), pivots)
    reach = vector_search.reachable(far, np.sqrt((points ** 2).sum(1)), scores, plan)
    assert reach.mean() < 0.2
    truth = points @ points.T >= scores[:, None]
    assert all(reach[q, near.argmin(1)[x]] for q, x in zip(*np.nonzero(truth)))


# --- conversation repair


def cheapest(turns):
    """Dijkstra over (row, state), by cost and then edits."""
    heap, done = [(0, "", 0, 0, ())], set()
    names, step = {"u": "user", "a": "assistant"}, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    while True:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(turns) and state in (0, 3):
            return cost, audit, "\n".join(out)
        if (at, state) in done:
            continue
        done.add((at, state))
        other = "a" if state == 2 else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", at, step[state, other], (*out, names[other] + ":")))
        if at < len(turns):
            role, text, fault = turns[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if (state, role[:1]) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, step[state, role[:1]], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, step[state, other], (*out, f"{names[other]}:{text}")))


def repaired(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = talks[conv]
        show = lambda x: " " if x is None else x
        h, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, kept in talks.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, turns = set(), []
        for _, role, text in kept:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            turns.append((role, text, "blank" if not end else "duplicate" if (role, text) in seen
                          else "" if end[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        cost, audit, body = cheapest(turns)
        numbers = {t for t, _, _ in kept if t is not None}
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
        faults = Counter(t[2] for t in turns)
        out.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, faults["blank"],
                    faults["duplicate"], faults["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256(body.encode()).hexdigest()))
    return out


turns_of = st.lists(st.builds(
    conversations.Turn, st.sampled_from(["user", "assistant", "system", "tool", "", " ", "User"]), st.sampled_from("xyz"),
    st.sampled_from(["", "", "blank", "duplicate", "truncated"])), max_size=11)


@given(turns_of, st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_branch_and_bound_finds_the_least(turns, size):
    cost, audit, body = cheapest(turns)
    found = conversations.search(turns, conversations.START, True)[conversations.ASSISTANT]
    assert found == (cost, audit)
    assert "\n".join(conversations.lines(turns, conversations.START, audit)) == body
    parts = [turns[i:i + size] for i in range(0, len(turns), size)]
    total, steps = conversations.joined(conversations.crossings(p) for p in parts)
    assert (total, "".join(e for _, e in steps)) == (cost, audit)
    assert "\n".join(x for p, (s, e) in zip([*parts, []], steps) for x in conversations.lines(p, s, e)) == body


@pytest.fixture(scope="module")
def talk_rows():
    rng = random.Random(3)
    texts = [None, "", " \t", "Yes.", "No!", "cut off", "été? ", "mid. end", "word " * 20_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", ""]
    rows = [(c, t if rng.random() > 0.05 else None, rng.choice(roles), rng.choice([*texts, f"x{rng.random()}."]))
            for c in range(60) for t in range(rng.randint(1, 9))]
    rows += rows[:20]  # repeated rows
    rows += [(None, i, "user", "a.") for i in range(3)] + [(70, None, None, None)]
    rows += [(80 + c, t, "user", "x") for c in range(40) for t in range(1)]  # some lose their only row
    # One conversation of most rows, with a hot repeated text and ties.
    return rows + [(500, t // 2, "user" if t % 2 == 0 else "assistant", "hot." if t % 3 else f"text {t}") for t in range(6000)]


def test_repair_of_conversations(spark, talk_rows):
    df = clashing(spark.createDataFrame(talk_rows, "conv_id long, turn long, role string, text string").repartition(5))
    got = conversations.damage_and_repair(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(repaired(talk_rows))
    assert conversations.damage_and_repair(df.limit(0)).count() == 0


# --- spelling groups


def spelled(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            counts[word[:h % len(word)] + word[h % len(word) + 1:] if h % 199 == 0 else word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    close = {w: [o for o in counts if near(w, o)] for w in counts}
    best = {w: min(close[w], key=lambda o: (-counts[o], o), default=None) for w in counts}
    form = {w: o if o and counts[o] >= 5 * counts[w] else None for w, o in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, n, len(close[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()]


def test_spelling_groups(spark, edge, empty):
    rng = random.Random(4)
    base = ["harbour", "lantern", "orchard", "étagère", "gradual", "reflect", "marbles"]

    def changed(word, times):
        for _ in range(times):
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice(["", word[at] + rng.choice("aeé"), rng.choice("xyzü")]) + word[at + 1:]
        return word

    words = [w.capitalize() for w in base for _ in range(700)]
    chain = ["harbour"] * 700 + ["harbuur"] * 130 + ["hirbuur"] * 26 + ["hirbuus"] * 5
    typos = [changed(rng.choice(base), rng.randint(1, 2)) for _ in range(300)]
    words += chain + [t for t in typos for _ in range(rng.choice([1, 5, 6, 40]))] + ["×÷×÷×÷", "aabbcc", "abcabc"] * 6
    rng.shuffle(words)
    rows = [(i, " ".join(words[at:at + 40]) + ".") for i, at in enumerate(range(0, len(words), 40))]
    rows += [*edge_rows(), (1, None), (None, "harbour-harbour"), rows[0]]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = spelling.group_spellings(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert Counter(map(tuple, got)) == Counter(spelled(rows))
    assert spelling.group_spellings(empty).count() == 0


@given(st.text("abcé", min_size=4, max_size=9), st.integers(0, 8), st.sampled_from(["", "a", "zq", "z"]))
@settings(max_examples=20, deadline=None)
def test_signatures_meet_within_two_letters(spark, word, at, put):
    """A letter taken out, replaced or added leaves a signature in common, for any number of parts."""
    at = at % len(word)
    other = word[:at] + put[:1] + word[at + (put != "zq"):]
    rows = spark.createDataFrame([(word,), (other,)], "word string")
    for parts in (3, 8):
        found = spelling.signed(rows, parts).groupBy("signature").agg(F.countDistinct("word").alias("n")).agg(F.max("n")).first()[0]
        assert found == (2 if other != word else 1)
