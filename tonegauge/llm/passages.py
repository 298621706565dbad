"""Fuzzy passages that documents share: seeds, collinear chains, alignment.

1. Word k-mers are seeds; those of a single class are dropped first. Seeds and matches travel as packed blobs to the
   bucket that owns them, and are met and chained there many at once. The classes of a seed that few have all meet. The
   occurrences of any other are matched with two leaders, the smallest and the largest
   class that has the seed, so a seed of m documents makes 2 m matches, never m squared.
   Where all seeds are of that kind, longer runs of words are seeds too, up to
   ``min_words``: those who share such a run share a passage with its leaders.
2. The matches of a pair of documents are chained: both positions rise, and a gap costs
   by its length. A Fenwick tree of best scores by position makes that n log n.
3. Chains of one short run whose extensions can't become long enough are dropped by a bound over all alignments of the
   words around them. The others are aligned word by word between their seeds and extended at both ends. A chain
   that joins passages around words that differ is split there.

Documents of equal words are one class; its members are reported as copies of its
smallest document and only that class takes part in the rest.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import SPACE, written
from tonegauge.llm.ngram_join import _mix

#: Every k-mer is a seed.
K, WINDOW = 5, 1
MIN_WORDS, MIN_IDENTITY = 40, 0.75
SEED_WEIGHT, GAP_COST = 8.0, 0.1
#: Words around a chain that its first alignment sees; what would go on gets the whole texts.
MARGIN = 64
#: An extension ends where it falls so far below its best; a word more counts 1, an edit -3.
DROP, EDIT = 15, 3
#: In a stretch of one repeated seed, one in so many is enough.
STRETCH = 16
#: Seeds that a task holds before it sends them.
BLOCK_SEEDS = 2_000_000
#: Bytes of texts whose words are hashed together.
TEXT_BYTES = 1 << 19
#: Words of texts that are looked at together; a number from APART on stands between two texts.
TOGETHER, APART = 1 << 18, 1 << 32
#: Words around a chain that tell whether it may become a passage.
REACH = 14
#: Up to so many classes with one seed all meet.
MANY = 8
#: Tasks that share the occurrences of a seed that many classes have.
SALTS = 8
FILTER_BITS = 1 << 26
#: More words than any text has (four bytes each, and a value has less than 2 GB).
WHOLE = (1 << 29) - 1


#: A number for every byte, A-Z as a-z, and the odd base of the words' polynomials modulo 2 ** 64.
_BYTES = np.random.default_rng(0).integers(0, 1 << 64, 256, np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_IN_WORD = ~np.isin(np.arange(256), np.frombuffer(SPACE.encode(), np.uint8))
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of UTF-8 texts: polynomials of their bytes, as differences of running sums."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if len(_POWERS[0]) < len(raw):
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.cumprod(np.append(np.ones(1, np.uint64), np.full(2 * len(raw), base, np.uint64)))
    edges = np.diff(_IN_WORD[raw].view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.cumsum(_BYTES[raw] * _POWERS[0][:len(raw)])
    sums = np.append(np.uint64(0), sums)
    hashes = _mix(_mix((sums[ends] - sums[starts]) * _POWERS[1][starts]) + (ends - starts).astype(np.uint64))
    return np.split(hashes, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])[:-1]))


def class_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _kmers(hashes: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(hashes) - k + 1)
    kmers = hashes[:n].copy()
    for j in range(1, k):
        kmers *= np.uint64(0xBF58476D1CE4E5B9)
        kmers += hashes[j:j + n]
    return _mix(kmers)


def long_seeds(hashes: np.ndarray, common: Callable[[np.ndarray], np.ndarray], k: int = K, window: int = WINDOW,
               min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of runs of 2 k, 4 k, ... and ``min_words`` words whose seeds all are ``common``.

    Of a stretch of one repeated word, runs at every STRETCH-th place are enough, so that its starts
    meet, and its last run under a hash of its own, so that its ends meet.
    """
    found, at = seeds(hashes, k, window)
    rare = np.zeros(len(hashes) + 1, np.int64)
    rare[at[~(common(found) & _whole(hashes, at, k))] + 1] = 1
    rare = np.cumsum(rare)
    # Where the stretch of equal words around each word starts and ends.
    cuts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))[:len(hashes)]
    sizes = np.diff(np.append(cuts, len(hashes)))
    low, high = np.repeat(cuts, sizes), np.repeat(cuts + sizes, sizes)
    runs, size, out = _kmers(hashes, k), k, []
    while size < min_words:
        longer = min(2 * size, min_words)
        n = max(0, len(hashes) - longer + 1)
        runs = _mix(runs[:n] * np.uint64(0xBF58476D1CE4E5B9) + runs[longer - size:longer - size + n])
        size = longer
        starts = np.flatnonzero(rare[size - k + 1:size - k + 1 + n] == rare[:n])
        flat, last = high[starts] >= starts + size, high[starts] == starts + size
        starts, ends = starts[~flat | last | ((starts - low[starts]) % STRETCH == 0)], starts[last]
        out += [(runs[starts], starts), (_mix(~runs[ends]), ends)]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (found[:0], at[:0])


def _whole(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one text."""
    apart = np.append(0, np.cumsum(hashes >= APART))
    return apart[at + size] == apart[at]


def seeds(hashes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """K-mer hashes and positions of the minimisers; any run of k + window - 1 words has one."""
    kmers = _kmers(hashes, k)
    n = len(kmers)
    if not n:
        return kmers, np.zeros(0, np.int64)
    if window == 1:
        at = np.arange(n)
    elif n <= window:
        at = np.array([int(kmers.argmin())])
    else:
        views = np.lib.stride_tricks.sliding_window_view(kmers, window)
        at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    found = kmers[at]
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    keep = rank % max(window, STRETCH) == 0
    return found[keep], at[keep]


class Fenwick:
    """Largest (score, item) over positions up to a given one."""

    def __init__(self, size: int):
        self.best = [(-1e300, -1)] * (size + 1)

    def add(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        """The best among positions below ``at``."""
        found = (-1e300, -1)
        while at > 0:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


def chains(x: np.ndarray, y: np.ndarray, weight: float = SEED_WEIGHT, gap: float = GAP_COST) -> list[list[int]]:
    """Collinear chains of matches, best first, each match in one chain at most.

    A chain scores ``weight`` per match less ``gap`` per word between matches in either text.
    """
    order = np.lexsort((-y, x))
    rank = np.unique(y, return_inverse=True)[1]
    tree, score, back = Fenwick(int(rank.max()) + 1), [0.0] * len(x), [-1] * len(x)
    xs, ys, ranks = x.tolist(), y.tolist(), rank.tolist()
    at, order = 0, order.tolist()
    while at < len(order):  # matches at one place of x can't follow each other
        end = at
        while end < len(order) and xs[order[end]] == xs[order[at]]:
            j = order[end]
            value, i = tree.upto(ranks[j])
            value -= gap * (xs[j] + ys[j])
            score[j], back[j] = (weight + value, i) if i >= 0 and value > 0 else (weight, -1)
            end += 1
        for j in order[at:end]:
            tree.add(ranks[j], (score[j] + gap * (xs[j] + ys[j]), j))
        at = end
    out, used = [], [False] * len(x)
    for j in sorted(range(len(x)), key=lambda j: -score[j]):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = back[j]
        if chain:
            out.append(chain[::-1])
    return out


def _edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common order (longest common subsequence) of two short gaps."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)))
    return int(row[-1])


def _reach(u: list, v: list) -> tuple[int, int, int, bool, bool]:
    """How far two texts stay alike from their starts, with edits: words of either, matches
    among them, and whether it came to the end of either.

    By number of edits, the furthest place on every diagonal that isn't too far below the best.
    """
    n, m, edits, top = len(u), len(v), 0, 0
    u, v = u + [-1], v + [-2]
    best, at_ends, front = (0, 0, 0), [False, False], {0: (0, 0)}
    while front:
        for diagonal, (i, hits) in front.items():
            j = i - diagonal
            if u[i] == v[j]:
                start = i
                while u[i] == v[j]:
                    i, j = i + 1, j + 1
                hits += i - start
                front[diagonal] = i, hits
            if i == n:
                at_ends[0] = True
            if j == m:
                at_ends[1] = True
            score = hits - EDIT * edits
            if score > top or score == top and hits > best[2]:
                top, best = score, (i, j, hits)
        edits, step = edits + 1, {}
        least = top - DROP + EDIT * edits
        for diagonal, (i, hits) in front.items():
            if hits < least:
                continue
            j, there = i - diagonal, (i + 1, hits)
            if i < n:
                if j < m and (diagonal not in step or there > step[diagonal]):
                    step[diagonal] = there
                if diagonal + 1 not in step or there > step[diagonal + 1]:
                    step[diagonal + 1] = there
            if j < m and (diagonal - 1 not in step or (i, hits) > step[diagonal - 1]):
                step[diagonal - 1] = i, hits
        front = step
    return *best, *at_ends


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, bool, bool]:
    size, n = MARGIN, min(len(a), len(b))
    differ = a[:n] != b[:n]
    same = int(differ.argmax()) if differ.any() else n  # words before the first edit
    a, b = a[same:], b[same:]
    while True:
        found = _reach(a[:size].tolist(), b[:size].tolist())
        if size >= max(len(a), len(b)) or not any(found[3:]):
            return found[0] + same, found[1] + same, found[2] + same, *found[3:]
        size *= 4


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = K) -> tuple[int, int, int, int, int]:
    """The passage of a chain in two word sequences: start and end in each, and words that match."""
    matched, ax, by = 0, int(x[0]), int(y[0])
    for i, j in zip(x.tolist(), y.tolist()):
        if i > ax or j > by:
            matched += _edit_matches(a[ax:i], b[by:j]) if i >= ax and j >= by else 0
        new = min(i + k - max(i, ax), j + k - max(j, by))
        matched += max(0, new)
        ax, by = max(ax, i + k), max(by, j + k)
    left, low, hits, *_ = _extend(a[:x[0]][::-1], b[:y[0]][::-1])
    right, high, more, *_ = _extend(a[ax:], b[by:])
    return int(x[0]) - left, ax + right, int(y[0]) - low, by + high, matched + hits + more


def alike(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = K, min_words: int = MIN_WORDS,
          min_identity: float = MIN_IDENTITY) -> tuple[list[tuple[int, int, int, int, int]], list[bool]]:
    """The passages of a chain, as ``align`` gives them: the whole chain if it is alike, or else
    the disjoint sub-chains that are and together have most matching words. Then whether the
    extensions came to the start of either text and to the end of either.

    Sub-chains start and end where the texts differ: words that match only raise the identity.
    """
    n = len(x)
    if n == 1 or (y[-1] - y[0] == x[-1] - x[0] and (x[1:] - x[:-1] == y[1:] - y[:-1]).all() and (x[1:] - x[:-1] <= k).all()):
        left, low, hits, *ends = _extend(a[:x[0]][::-1], b[:y[0]][::-1])
        right, high, more, *past = _extend(a[x[-1] + k:], b[y[-1] + k:])
        s, e, t, f = int(x[0]) - left, int(x[-1]) + k + right, int(y[0]) - low, int(y[-1]) + k + high
        hits += int(x[-1] - x[0]) + k + more
        fine = e - s >= min_words <= f - t and hits >= min_identity * max(e - s, f - t)
        return [(s, e, t, f, hits)] if fine else [], ends + past
    gained, dy = np.diff(x, prepend=x[:1]).astype(np.int64), np.diff(y, prepend=y[:1])
    level = (gained == dy) & (gained > 0) & (gained <= k)
    gained[:1] = 0
    for j in np.flatnonzero(~level[1:]) + 1:
        ax, by, i, o = int(x[j - 1]) + k, int(y[j - 1]) + k, int(x[j]), int(y[j])
        between = _edit_matches(a[ax:i], b[by:o]) if i >= ax and o >= by else 0
        gained[j] = between + max(0, min(i + k - max(i, ax), o + k - max(o, by)))
        level[j] = gained[j] == i - x[j - 1] == o - y[j - 1]
    firsts = np.flatnonzero(~level)
    lasts = np.append(firsts[1:], n) - 1
    total = np.cumsum(gained)
    left, low, hits, *ends = _extend(a[:x[0]][::-1], b[:y[0]][::-1])
    right, high, more, *past = _extend(a[x[-1] + k:], b[y[-1] + k:])
    ends += past
    s, e, t, f = int(x[0]) - left, int(x[-1]) + k + right, int(y[0]) - low, int(y[-1]) + k + high
    hits += k + int(total[-1]) + more
    if e - s >= min_words <= f - t and hits >= min_identity * max(e - s, f - t):
        return [(s, e, t, f, hits)], ends
    if len(firsts) == 1:
        return [], ends
    before, after = [], []
    for f, e in zip(firsts.tolist(), lasts.tolist()):
        low = (int(x[f - 1]) + k, int(y[f - 1]) + k) if f else (0, 0)
        high = (int(x[e + 1]), int(y[e + 1])) if e + 1 < n else (len(a), len(b))
        before.append(_extend(a[low[0]:x[f]][::-1], b[low[1]:y[f]][::-1]))
        after.append(_extend(a[x[e] + k:high[0]], b[y[e] + k:high[1]]))
    before, after = np.array(before, np.int64), np.array(after, np.int64)
    s, t = x[firsts] - before[:, 0], y[firsts] - before[:, 1]
    e, f = x[lasts] + k + after[:, 0], y[lasts] + k + after[:, 1]
    head, tail = k - total[firsts] + before[:, 2], total[lasts] + after[:, 2]

    best, back = np.zeros(len(firsts) + 1), []
    for j in range(len(firsts)):
        left, right, hits = e[j] - s[:j + 1], f[j] - t[:j + 1], head[:j + 1] + tail[j]
        fine = (np.minimum(left, right) >= min_words) & (hits >= min_identity * np.maximum(left, right))
        value = np.where(fine, best[:j + 1] + hits, -1)
        i = int(value.argmax())
        best[j + 1], i = (value[i], i) if value[i] > best[j] else (best[j], -1)
        back.append(i)
    out, j = [], len(firsts) - 1
    while j >= 0:
        i = back[j]
        if i >= 0:
            out.append((int(s[i]), int(e[j]), int(t[i]), int(f[j]), int(head[i] + tail[j])))
        elif before[j, 3:].any() or after[j, 3:].any():
            # The next match may be off the way of this sub-chain, which then goes on past it.
            first, last = firsts[j], lasts[j]
            left, low, hits, *reached = _extend(a[:x[first]][::-1], b[:y[first]][::-1])
            right, high, more, *past = _extend(a[x[last] + k:], b[y[last] + k:])
            ends = [old or new for old, new in zip(ends, reached + past)]
            s0, e0, t0, f0 = int(x[first]) - left, int(x[last]) + k + right, int(y[first]) - low, int(y[last]) + k + high
            total0 = k + int(total[last] - total[first]) + hits + more
            if e0 - s0 >= min_words <= f0 - t0 and total0 >= min_identity * max(e0 - s0, f0 - t0):
                out.append((s0, e0, t0, f0, total0))
        j = i - 1 if i >= 0 else j - 1
    return out[::-1], ends


def _bits(values: DataFrame, column: str, size: int = FILTER_BITS) -> np.ndarray:
    """A bit map of a column's values modulo ``size``, all that the driver sees of them."""
    spot = F.pmod(F.col(column), F.lit(size)) + 1
    rows = (values.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).toLocalIterator())
    bits = np.zeros(size // 8 + 4096, np.uint8)
    for row in rows:
        at = 4096 * (row["bucket"] - 1)
        bits[at:at + 4096] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def _in(bits: np.ndarray, size: int, values: np.ndarray) -> np.ndarray:
    spot = (values % values.dtype.type(size)).astype(np.int64)
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


def _planes(*columns: np.ndarray) -> bytes:
    """Equally long columns of numbers as byte planes, which pack well where the numbers are small."""
    return b"".join(c.astype(c.dtype.newbyteorder(">")).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def _from_planes(raw: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(kind).newbyteorder(">")).astype(kind))
        at += n * size
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    """What is between ascending numbers; ``np.cumsum`` undoes it."""
    return np.diff(values.astype(np.uint64), prepend=np.uint64(0))


def _numbered(*columns: np.ndarray) -> tuple[bytes, list[np.ndarray]]:
    """The distinct classes of the columns, and the columns as numbers among them."""
    table, index = np.unique(np.concatenate(columns), return_inverse=True)
    return table.tobytes(), np.split(index.astype(np.uint32), np.cumsum([len(c) for c in columns])[:-1])


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _by_bucket(sent: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Rows that ``work`` makes of all blobs of a bucket, which come as rows (bucket, classes, blob)."""
    def run(batches):
        now, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "classes", "blob"))):
                if row[0] != now and held:
                    yield from work(held)
                    held = []
                now = row[0]
                held.append(row)
        if held:
            yield from work(held)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


_BLOBS = "bucket int, classes binary, blob binary"


def _blobs(rows: list) -> pa.RecordBatch:
    return _rows(rows, ["bucket", "classes", "blob"], [pa.int32(), pa.binary(), pa.binary()])


def _texts(batches, find: Callable):
    """Per some texts their classes, and of all their seeds the number of the text, the seed and its place.

    Copies that other tasks read may come again.
    """
    done, held, n = set(), [], 0

    def found():
        owners, texts = zip(*held)
        sizes = np.array([len(t) // 4 + 1 for t in texts])
        ends = np.cumsum(sizes)
        hashes = np.frombuffer(b"\0\0\0\0".join([*texts, b""]), "<u4").astype(np.uint64)
        hashes[ends - 1] = APART + np.arange(len(ends))
        values, at = find(hashes)
        text = np.searchsorted(ends, at, "right")
        return np.array(owners, np.int64), text, values, at - (ends - sizes)[text]

    for batch in batches:
        for own, words in zip(batch.column("class_id").to_pylist(), batch.column("words")):
            if own in done:
                continue
            done.add(own)
            held.append((own, words.as_buffer()))
            n += len(held[-1][1]) // 4
            if n > TOGETHER:
                yield found()
                held, n = [], 0
    if held:
        yield found()


def _seeds_of_texts(hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    found, at = seeds(hashes, k, window)
    keep = _whole(hashes, at, k)
    return found[keep], at[keep]


def _shared(bodies: DataFrame, n_words: int, k: int, window: int) -> Callable[[np.ndarray], np.ndarray]:
    """A test of seeds that holds for all that two classes have, and for few others.

    Each task sends the distinct first bits of its seeds, and once more those that several
    of its classes have, to the bucket that owns them: so many bits that few seeds share them by chance.
    """
    buckets = int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = min(40, max(28, (128 * n_words).bit_length()))

    def blocks(held):
        values = np.sort(np.concatenate(held))
        same = values[1:] == values[:-1]
        again = values[1:][same]
        again = again[np.append(True, again[1:] != again[:-1])[:len(again)]]
        for sent in (values[np.append(True, ~same)[:len(values)]], again):
            cuts = np.searchsorted(_bucket(sent << np.uint64(64 - width), buckets), np.arange(buckets + 1))
            yield from ((i, None, _planes(_steps(sent[cuts[i]:cuts[i + 1]])))
                        for i in np.flatnonzero(np.diff(cuts)).tolist())

    def send(batches):
        held, n = [], 0
        for _, text, found, _ in _texts(batches, lambda hashes: _seeds_of_texts(hashes, k, window)):
            of_text = np.sort(text.astype(np.uint64) << np.uint64(width) | found >> np.uint64(64 - width))
            held.append(of_text[np.append(True, of_text[1:] != of_text[:-1])[:len(of_text)]] & np.uint64((1 << width) - 1))
            n += len(held[-1])
            if n > BLOCK_SEEDS:
                yield _blobs(list(blocks(held)))
                held, n = [], 0
        if held:
            yield _blobs(list(blocks(held)))

    def several(held):
        values = np.sort(np.concatenate([np.cumsum(*_from_planes(blob, "u8")) for *_, blob in held]))
        again = values[1:][values[1:] == values[:-1]]
        again = again[np.append(True, again[1:] != again[:-1])[:len(again)]]
        yield pa.RecordBatch.from_arrays([pa.array(again.astype(np.int64))], names=["top"])

    top = written(_by_bucket(bodies.mapInArrow(send, _BLOBS), several, "top long"), "shared")
    size = 1 << min(30, max(23, (8 * top.count()).bit_length()))
    bits = _bits(top, "top", size)
    return lambda found: _in(bits, size, (found >> np.uint64(64 - width)).astype(np.int64))


def _occurrences(bodies: DataFrame, find: Callable, buckets: int, leaders: bool) -> DataFrame:
    """The seeds of the texts, sorted, as blobs for the buckets that own them.

    With ``leaders``, a seed that more than MANY classes of a block have is sent with the
    smallest and the largest of them only, and marked.
    """
    def block(held, salt):
        own, found, at = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(found, kind="stable")  # of equal seeds, those of a class lie together, by place
        found, own, at = found[order], own[order], at[order].astype(np.uint32)
        if leaders and len(found):
            new = np.append(True, found[1:] != found[:-1])
            first = new | np.append(True, own[1:] != own[:-1])
            group = np.cumsum(new) - 1
            hot = (np.bincount(group, first) > MANY)[group]
            some = np.flatnonzero(hot & first)
            some = some[np.lexsort((own[some], group[some]))]
            ends = np.append(True, group[some][1:] != group[some][:-1])[:len(some)]
            keep = ~hot
            keep[some[ends | np.append(ends[1:], True)[:len(some)]]] = True
            found, own, at = found[keep], own[keep], at[keep] | hot[keep].astype(np.uint32) << 31
        cuts = np.searchsorted(_bucket(found, buckets), np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[i], cuts[i + 1])
            classes, (number,) = _numbered(own[part])
            key = i if leaders else SALTS * i + salt % SALTS
            yield key, classes, _planes(_steps(found[part]), number, at[part])

    def send(batches):
        held, n, sent = [], 0, 0
        for owners, text, found, at in _texts(batches, find):
            if not sent:
                sent = int(owners[0])  # tasks begin anywhere among the SALTS
            held.append((owners[text], found, at))
            n += len(found)
            if n > BLOCK_SEEDS // 2:
                yield _blobs(list(block(held, sent)))
                held, n, sent = [], 0, sent + 1
        if held:
            yield _blobs(list(block(held, sent)))

    return bodies.mapInArrow(send, _BLOBS)


def _entries(held: list) -> list[np.ndarray]:
    """Seeds, classes and places from blobs."""
    parts = []
    for _, classes, blob in held:
        steps, number, at = _from_planes(blob, "u8", "u4", "u4")
        parts.append((np.cumsum(steps), np.frombuffer(classes, np.int64)[number], at))
    return [np.concatenate(c) for c in zip(*parts)]


def _pairs(own: np.ndarray, x: np.ndarray, other: np.ndarray, y: np.ndarray, buckets: int):
    """Matches as blobs for the buckets that own their pairs; the smaller class of a pair comes first."""
    turned = own > other
    a, b = np.where(turned, other, own), np.where(turned, own, other)
    x, y = np.where(turned, y, x).astype(np.uint32), np.where(turned, x, y).astype(np.uint32)
    bucket = _bucket(_mix(_mix(a.view(np.uint64)) + b.view(np.uint64)), buckets)
    order = np.lexsort((x, b, a, bucket))
    a, b, x, y = a[order], b[order], x[order], y[order]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[i], cuts[i + 1])
        classes, numbers = _numbered(a[part], b[part])
        yield i, classes, _planes(*numbers, x[part], y[part])


def _meetings(bodies: DataFrame, find: Callable, name: str) -> tuple[DataFrame, Callable[[np.ndarray], np.ndarray]]:
    """Matches of the seeds that ``find`` gives, as blobs by pair of classes, and a test of seeds that
    holds for those that more than MANY classes have.

    Every occurrence of a seed meets its first occurrence in every other class that has it,
    or in the smallest and the largest class if many have it.
    """
    spark = bodies.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = _BLOBS + ", seed long, low long, low_pos int, high long, high_pos int"
    names = [c.split()[0] for c in schema.split(", ")]

    def meet(held):
        found, own, at = _entries(held)
        marked, at = at >> 31 > 0, at & 0x7FFFFFFF
        order = np.lexsort((np.unique(own, return_inverse=True)[1] << 32 | at, found))
        found, own, at, marked = found[order], own[order], at[order], marked[order]
        new = np.append(True, found[1:] != found[:-1])
        first = new | np.append(True, own[1:] != own[:-1])
        keep = first | np.append(True, at[1:] != at[:-1])  # copies in other tasks repeat entries
        found, own, at, first, new = found[keep], own[keep], at[keep], first[keep], new[keep]
        group = np.cumsum(new) - 1
        firsts = np.flatnonzero(first)
        starts = np.searchsorted(group[firsts], np.arange(group[-1] + 2))
        n = np.diff(starts)
        hot = n > MANY
        hot[group[np.flatnonzero(marked[keep])]] = True
        out = []
        for j in range(MANY):  # with the first occurrence in the j-th class
            left = np.flatnonzero((~hot & (n > j) & (n > 1))[group])
            right = firsts[starts[group[left]] + j]
            both = (own[left] != own[right]) & ~(first[left] & (own[left] > own[right]))
            out.append((left[both], right[both]))
        left, right = (np.concatenate(c) for c in zip(*out))
        rows = list(_pairs(own[left], at[left], own[right], at[right], buckets))
        for i in range(0, len(rows), 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows[i:i + 16]), (pa.int32(), pa.binary(), pa.binary()))]
                + [pa.nulls(len(rows[i:i + 16]), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())],
                names=names)
        led = np.flatnonzero(hot & (n > 1))
        low, high = firsts[starts[led]], firsts[starts[led + 1] - 1]
        columns = [found[low].view(np.int64), own[low], at[low].astype(np.int32), own[high], at[high].astype(np.int32)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(led), t) for t in (pa.int32(), pa.binary(), pa.binary())] + [pa.array(c) for c in columns],
            names=names)

    met = written(_by_bucket(_occurrences(bodies, find, buckets, True), meet, schema), f"{name}-met")
    led = met.where("seed IS NOT NULL")
    bits = _bits(led, "seed")
    frequent = lambda found: _in(bits, FILTER_BITS, found.view(np.int64))

    def leaders(batches):
        for batch in batches:
            seed, low, low_pos, high, high_pos = (batch.column(c).to_numpy() for c in names[3:])
            order = np.argsort(seed.view(np.uint64))
            bucket = _bucket(seed.view(np.uint64)[order], buckets)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                part = order[cuts[i]:cuts[i + 1]]
                blob = _planes(_steps(seed.view(np.uint64)[part]), low[part], high[part],
                               low_pos[part].astype(np.uint32), high_pos[part].astype(np.uint32))
                yield _blobs([(SALTS * i + salt, None, blob) for salt in range(SALTS)])

    def meet_leaders(held):
        parts = [_from_planes(blob, "u8", "i8", "i8", "u4", "u4") for _, classes, blob in held if classes is None]
        if not parts:
            return
        seed, low, high, low_pos, high_pos = (np.concatenate(c) for c in zip(*((np.cumsum(p[0]), *p[1:]) for p in parts)))
        order = np.argsort(seed)
        seed, low, high, low_pos, high_pos = seed[order], low[order], high[order], low_pos[order], high_pos[order]
        for row in held:
            if row[1] is None:
                continue
            found, own, at = _entries([row])
            spot = np.minimum(np.searchsorted(seed, found), len(seed) - 1)
            for other, place in ((low, low_pos), (high, high_pos)):
                some = np.flatnonzero((seed[spot] == found) & (other[spot] != own))
                yield _blobs(list(_pairs(own[some], at[some], other[spot[some]], place[spot[some]], buckets)))

    def often(hashes):
        found, at = find(hashes)
        keep = frequent(found)
        return found[keep], at[keep]

    rest = _by_bucket(led.mapInArrow(leaders, _BLOBS).union(_occurrences(bodies, often, buckets, False)),
                      meet_leaders, _BLOBS)
    return met.where("seed IS NULL").select("bucket", "classes", "blob").union(rest), frequent


def _all_matches(bodies: DataFrame, n_words: int, k: int, window: int, min_words: int) -> DataFrame:
    shared = _shared(bodies, n_words, k, window)

    def some(hashes):
        found, at = seeds(hashes, k, window)
        keep = shared(found) & _whole(hashes, at, k)
        return found[keep], at[keep]

    met, frequent = _meetings(bodies, some, "seeds")
    longer, _ = _meetings(bodies, lambda hashes: long_seeds(hashes, frequent, k, window, min_words), "long-seeds")
    return met.union(longer)


def quick_chains(pair: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains of the matches of many pairs at once, sorted by pair, x and y: where each chain ends,
    and which matches are of pairs that ``chains`` has to do.

    Where both places rise from match to match, the match before is the best one to follow, and
    what follows the highest score of a run is a chain of its own. Scores are counted in tenths.
    """
    n, weight, gap, far = len(x), round(10 * SEED_WEIGHT), round(10 * GAP_COST), 1 << 37
    new = np.append(True, pair[1:] != pair[:-1])
    dx, dy = np.diff(x, prepend=0), np.diff(y, prepend=0)
    gain = np.where(new, -far, weight - gap * (dx + dy))
    total = np.cumsum(gain)
    over = total - np.minimum.accumulate(total)  # the score, less the match itself
    start = over == 0
    score = over + weight
    hard = ~new & ((dx <= 0) | (dy <= 0) | (start & (np.append(0, over[:-1]) + gain == 0)))
    run = np.cumsum(start)
    best = np.maximum.accumulate((score - far * run)[::-1])[::-1]
    last = np.append(run[1:] != run[:-1], True)
    later = np.append(best[1:], 0) + far * run
    hard |= ~last & (score == later)
    of_pair = np.cumsum(new) - 1
    return last | (score > later), (np.bincount(of_pair, hard) > 0)[of_pair]


_CHAIN = "a long, b long, a_from int, a_to int, b_from int, b_to int, short boolean, xs binary, ys binary"


def _chained(matches: DataFrame, k: int, min_words: int) -> DataFrame:
    """Chains with REACH words around them; ``short`` ones are one run of fewer than ``min_words`` words."""
    names = [c.split()[0] for c in _CHAIN.split(", ")]

    def parts(values, ends):
        """The values as one binary for each chain."""
        offsets = np.append(0, 4 * ends).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values.astype("<i4"))])

    def work(held):
        columns = []
        for _, classes, blob in held:
            a, b, x, y = _from_planes(blob, "u4", "u4", "u4", "u4")
            classes = np.frombuffer(classes, np.int64)
            columns.append((classes[a], classes[b], x.astype(np.int64) << 32 | y))
        a, b, place = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((place, b, a))
        a, b, place = a[order], b[order], place[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        keep = fresh | np.append(True, place[1:] != place[:-1])  # copies in other tasks repeat matches
        a, b, place, pair = a[keep], b[keep], place[keep], np.cumsum(fresh)[keep]
        x, y = place >> 32, place & 0xFFFFFFFF
        ends, hard = quick_chains(pair, x, y)
        order, sizes = [np.flatnonzero(~hard)], [np.diff(np.append(-1, np.flatnonzero(ends[~hard])))]
        some = np.flatnonzero(hard)
        for group in np.split(some, np.flatnonzero(np.diff(pair[some])) + 1) if len(some) else []:
            for chain in chains(x[group], y[group]):
                order.append(group[chain])
                sizes.append([len(chain)])
        order, sizes = np.concatenate(order), np.concatenate(sizes)
        a, b, x, y, ends = a[order], b[order], x[order], y[order], np.cumsum(sizes)
        starts = ends - sizes
        joined = np.append(0, np.cumsum((np.diff(x) != np.diff(y)) | (np.diff(x) > k)))
        short = (joined[ends - 1] == joined[starts]) & (x[ends - 1] - x[starts] < min_words - k)
        at = 0
        while at < len(ends):  # about a million matches at a time
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + 1_000_000, "right")))
            low, high, lo, hi = starts[at:to], ends[at:to] - 1, starts[at], ends[to - 1]
            yield pa.RecordBatch.from_arrays([
                pa.array(a[low]), pa.array(b[low]),
                *(pa.array(c.astype(np.int32)) for c in (np.maximum(0, x[low] - REACH), x[high] + k + REACH,
                                                         np.maximum(0, y[low] - REACH), y[high] + k + REACH)),
                pa.array(short[at:to]), parts(x[lo:hi], ends[at:to] - lo), parts(y[lo:hi], ends[at:to] - lo)], names=names)
            at = to

    return _by_bucket(matches, work, _CHAIN)


def reach_bound(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For many pairs of equally many words, one pair in a row: no extension over them ends further
    in a or in b than this, or it may go on past them.

    All alignments in a band that holds every one that ``_reach`` may follow, by their best scores.
    """
    rows, n = a.shape
    band = (n + DROP) // EDIT
    far_a, far_b, alive = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, bool)
    score = {j: np.full(rows, -EDIT * j, np.int8) for j in range(min(band, n) + 1)}
    never = np.full(rows, -100, np.int8)
    for i in range(1, n + 1):
        row = {}
        for j in range(max(0, i - band), min(n, i + band) + 1):
            best = score.get(j, never) - np.int8(EDIT)
            if j:
                np.maximum(best, row.get(j - 1, never) - np.int8(EDIT), out=best)
                step = np.where(a[:, i - 1] == b[:, j - 1], np.int8(1), np.int8(-EDIT))
                np.maximum(best, score.get(j - 1, never) + step, out=best)
            row[j] = np.maximum(best, np.int8(-100))
            fine = best >= 0
            far_a[fine] = i
            if i == n or j == n:
                alive |= best >= -DROP
            np.maximum(far_b, j, out=far_b, where=fine)
        score = row
    return far_a, far_b, alive


def _around(parts: pa.Array, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A byte for each of the REACH words before ``first`` and from ``last`` on, 0 beyond the ends of a binary."""
    offsets = np.frombuffer(parts.buffers()[1], np.int32, len(parts) + 1, 4 * parts.offset).astype(np.int64) // 4
    words = np.frombuffer(parts.buffers()[2], "<u4") if offsets[-1] else np.zeros(1, "<u4")
    steps = np.arange(REACH)
    at = np.concatenate([first[:, None] - 1 - steps, last[:, None] + steps], axis=1)
    inside = (at >= 0) & (at < np.diff(offsets)[:, None])
    return np.where(inside, words[np.where(inside, offsets[:-1, None] + at, 0)] % 255 + 1, 0).astype(np.uint8)


def _likely(chained: DataFrame, bodies: DataFrame, k: int, min_words: int) -> DataFrame:
    """Without the short chains whose extensions, whatever is beyond the words around them, stay too short.

    A byte stands for each word, so that words that differ may pass for equal ones but never the other way.
    """
    names = [c.split()[0] for c in _CHAIN.split(", ")]

    def columns(batch, *wanted):
        return (batch.column(c).to_numpy().astype(np.int64) for c in wanted)

    def narrow(batches):
        for batch in batches:
            x, end, a_from = columns(batch, "x", "x_end", "a_from")
            around = _around(batch.column("left"), x - a_from, end - a_from) if batch.num_rows else np.zeros(0, np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in narrowed[:-1]] + [pa.array([r.tobytes() for r in around], pa.binary())], names=narrowed)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, low, high, b_from = columns(batch, "x", "y", "x_end", "y_end", "b_from")
            a = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint8).reshape(len(x), -1)
            b = _around(batch.column("right"), y - b_from, high - b_from)
            a, b = np.where(a, a, -1).astype(np.int16), np.where(b, b, -2).astype(np.int16)
            before, after = reach_bound(a[:, :REACH], b[:, :REACH]), reach_bound(a[:, REACH:], b[:, REACH:])
            fine = (low - x + before[0] + after[0] >= min_words) & (high - y + before[1] + after[1] >= min_words)
            yield batch.select(names).filter(pa.array(fine | before[2] | after[2]))

    short = chained.where("short").withColumns({
        "x": F.when(F.col("a_from") > 0, F.col("a_from") + REACH).otherwise(_number("xs")),
        "y": F.when(F.col("b_from") > 0, F.col("b_from") + REACH).otherwise(_number("ys")),
        "x_end": F.col("a_to") - REACH, "y_end": F.col("b_to") - REACH})
    schema = _CHAIN + ", x int, y int, x_end int, y_end int, around binary"
    narrowed = [c.split()[0] for c in schema.split(", ")]
    near = _with_part(short, bodies, "a", "left").mapInArrow(narrow, schema)
    return chained.where("not short").union(_with_part(near, bodies, "b", "right").mapInArrow(run, _CHAIN))


def _number(column: str):
    """The first of the little-endian numbers in a binary."""
    return F.conv(F.hex(F.reverse(F.substring(column, 1, 4))), 16, 10).cast("int")


def _rows(rows: list, names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _once(texts: DataFrame) -> DataFrame:
    return texts.groupBy("class_id").agg(F.first("words").alias("words"))


def _with_part(chained: DataFrame, bodies: DataFrame, side: str, name: str) -> DataFrame:
    part = F.expr(f"substring(words, 4 * {side}_from + 1, 4 * ({side}_to - {side}_from))")
    return chained.join(bodies, chained[side] == bodies.class_id).select(chained["*"], part.alias(name))


def _aligned(chained: DataFrame, bodies: DataFrame, k: int, min_words: int, min_identity: float) -> DataFrame:
    """Passages of the chains, or of their parts, whose aligned words are enough and alike.

    A chain that may go on beyond the words around it comes back as a row with ``xs`` and ``ys``,
    which may be lists of those of several chains.
    """
    schema = "a long, b long, a_start int, a_end int, b_start int, b_end int, n_match int, xs binary, ys binary"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 2 + [pa.int32()] * 5 + [pa.binary()] * 2

    cut = _with_part(_with_part(chained, bodies, "a", "left"), bodies, "b", "right")

    def chains_of(batch):
        columns = ("a", "b", "a_from", "a_to", "b_from", "b_to", "xs", "ys", "left", "right")
        for *row, xs, ys, left, right in zip(*(batch.column(c).to_pylist() for c in columns)):
            left, right = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
            for one in zip(*(v if isinstance(v, list) else [v] for v in (xs, ys))):
                yield *row, *one, left, right

    def run(batches):
        for batch in batches:
            out = []
            for a, b, a_from, a_to, b_from, b_to, xs, ys, left, right in chains_of(batch):
                x, y = (np.frombuffer(v, "<i4") for v in (xs, ys))
                rows, ends = alike(left, right, x - a_from, y - b_from, k, min_words, min_identity)
                cut = a_from > 0, b_from > 0, len(left) == a_to - a_from, len(right) == b_to - b_from
                if any(end and more for end, more in zip(ends, cut)):
                    out.append((a, b, None, None, None, None, None, xs, ys))
                    continue
                for s, e, t, f, n in rows:
                    out.append((a, b, a_from + s, a_from + e, b_from + t, b_from + f, n, None, None))
            yield _rows(out, names, kinds)

    return cut.mapInArrow(run, schema)


def _outermost(found: DataFrame) -> DataFrame:
    """Without the passages that lie within another one of their pair in both texts."""
    names = ["a", "b", "a_start", "a_end", "b_start", "b_end", "n_match"]
    kinds = [pa.int64()] * 2 + [pa.int32()] * 5

    def of_pair(rows):
        rows = np.unique(np.concatenate(rows), axis=0)
        rows = rows[np.argsort(-(rows[:, 3] - rows[:, 2] + rows[:, 5] - rows[:, 4]), kind="stable")]
        while len(rows):
            s, e, t, f = rows[0, 2:6]
            yield tuple(rows[0].tolist())
            rows = rows[(rows[:, 2] < s) | (rows[:, 3] > e) | (rows[:, 4] < t) | (rows[:, 5] > f)]

    def run(batches):
        held, pair = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, out = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], axis=1), []
            cuts = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
            for group in np.split(rows, cuts[1:]):
                if tuple(group[0, :2]) != pair and held:
                    out += of_pair(held)
                    held = []
                pair = tuple(group[0, :2])
                held.append(group)
            yield _rows(out, names, kinds)
        yield _rows(list(of_pair(held)) if held else [], names, kinds)

    return found.select(names).repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(
        run, "a long, b long, a_start int, a_end int, b_start int, b_end int, n_match int")


def repeated_passages(docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS,
                      min_identity: float = MIN_IDENTITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs of documents with a passage in common, in words from 0, ends excluded.

    Rows: doc_id, start_word, end_word, other_doc_id, other_start, other_end, n_match,
    kind. ``passage`` pairs stand between the smallest documents of two classes; ``copy``
    rows tie every further document of a class of ``min_words`` words or more to its
    smallest. A passage has at least ``min_words`` words on both sides, of which
    ``min_identity`` match. Null, empty and short texts have none; rows that repeat are
    copies of each other. Null ids are passed over as a class's smallest while there is another.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        done = set()
        for batch in batches:
            sizes, owners, words = [], [], []
            bodies = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            cuts = np.flatnonzero(np.diff(np.cumsum([0, *map(len, bodies)]) // TEXT_BYTES, prepend=0)).tolist()
            for low, high in zip([0, *cuts], [*cuts, len(bodies)]):
                for hashes in word_hashes(bodies[low:high]) if low < high else ():
                    own = class_of(hashes)
                    sizes.append(len(hashes))
                    owners.append(own)
                    words.append(None if own in done else hashes.astype("<u4").tobytes())
                    done.add(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(owners, pa.int64()),
                 pa.array(words, pa.binary())], names=["doc_id", "n_words", "class_id", "words"])

    members = written(source.mapInArrow(run, "doc_id long, n_words int, class_id long, words binary"), "members")
    texts = members.where("words IS NOT NULL").select("class_id", "words")
    n_words = members.agg(F.sum(F.col("n_words").cast("long"))).first()[0] or 0
    chained = written(_chained(_all_matches(texts, n_words, k, window, min_words), k, min_words), "chains")
    bodies = _once(texts)
    more = MARGIN - REACH
    chained = _likely(chained, bodies, k, min_words).select(
        "a", "b", F.greatest(F.lit(0), F.col("a_from") - more).alias("a_from"), (F.col("a_to") + more).alias("a_to"),
        F.greatest(F.lit(0), F.col("b_from") - more).alias("b_from"), (F.col("b_to") + more).alias("b_to"), "xs", "ys")
    found = written(_aligned(chained, bodies, k, min_words, min_identity), "passages")
    whole = [F.lit(v).cast("int").alias(c) for c, v in
             (("a_from", 0), ("a_to", WHOLE), ("b_from", 0), ("b_to", WHOLE))]
    open_ended = found.where("xs IS NOT NULL").groupBy("a", "b").agg(F.collect_list(F.struct("xs", "ys")).alias("of"))
    used = _bits(open_ended.select(F.col("a").alias("class_id")).union(open_ended.select("b")), "class_id")
    some = texts.mapInArrow(lambda batches: (b.filter(pa.array(_in(used, FILTER_BITS, b.column("class_id").to_numpy())))
                                             for b in batches), texts.schema)
    more = _aligned(open_ended.select("a", "b", *whole, "of.xs", "of.ys"), _once(some), k, min_words, min_identity)
    found = _outermost(found.where("xs IS NULL").union(written(more, "long-passages")))
    groups = members.groupBy("class_id").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    one = groups.select(F.col("class_id").alias("a"), "doc_id")
    other = groups.select(F.col("class_id").alias("b"), F.col("doc_id").alias("other_doc_id"))
    passages = found.join(one, "a").join(other, "b").select(
        "doc_id", F.col("a_start").alias("start_word"), F.col("a_end").alias("end_word"), "other_doc_id",
        F.col("b_start").alias("other_start"), F.col("b_end").alias("other_end"), "n_match",
        F.lit("passage").alias("kind"))
    whole = members.where(F.col("n_words") >= min_words).select("doc_id", "n_words", "class_id")
    first = groups.where("n > 1").select("class_id", F.col("doc_id").alias("other_doc_id"), "n")
    copies = whole.join(first, "class_id").where(~F.col("doc_id").eqNullSafe(F.col("other_doc_id"))).select(
        "doc_id", F.lit(0).alias("start_word"), F.col("n_words").alias("end_word"), "other_doc_id",
        F.lit(0).alias("other_start"), F.col("n_words").alias("other_end"), F.col("n_words").alias("n_match"),
        F.lit("copy").alias("kind"))
    return passages.unionByName(copies)
