"""Documents whose word shingles overlap: an exact Jaccard join with signature trees.

1. Documents with equal shingle sets are one class. Each class announces its prefix, the
   first n - ceil(0.75 n) + 1 shingles of a fixed order; two sets that link share one.
2. Leaders: in a group of classes that share a shingle and have like sizes, each class is
   compared with a few leaders, which joins the members of large groups by few links.
3. Trees: groups that still hold more than one component get a signature tree. Nodes hold
   OR-combined bitmaps and size ranges; a dual traversal drops node pairs that are one
   component or whose largest possible overlap is too small. A pair is left to the smallest
   shared shingle that both classes know of, so that it isn't found again at each one. A
   large group is cut into blocks by size and hash, and pairs of blocks that sizes allow are
   cells of their own. What is left is compared.

Pairs are first bounded by bitmaps as wide as their sets are large; those that may link
are compared by their whole shingle sets. Nothing is dropped: leaders only spare work, and
the last step covers every pair of different components that shares a prefix shingle.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import batches_by_bytes, byte_words, written

WORDS, PERCENT = 5, 75
BITS = 1024
#: The share of documents that says which shingles to put last in the order. Any order gives the
#: same links; a good one keeps passages that many documents share out of the prefixes.
ORDER_SHARE, COMMON_FROM, COMMON_MOST = 1 / 8, 4, 500_000
#: Bits of the fixed-size filter of classes whose sets are wanted.
FILTER_BITS = 1 << 26
ROUNDS, LEADERS = 2, 2
LEAF, FANOUT = 32, 8
#: Most rows of a block of a large group; smaller groups are one cell.
BLOCK = 8192
#: A class tells others this many of its smallest shared keys.
FIRSTS, NO_KEY = 16, (1 << 63) - 1
#: Bytes of bitmaps, sets or keys after which a task sends on what it has.
SEND_BYTES = 8 << 20


class WordHashes(dict):
    """64-bit hashes of words; a worker remembers at most ``most`` of them."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of fewer words, one for the whole sequence."""
    found = byte_words(text, lower=True)
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = len(h) - words + 1
    key = h[:n].copy()
    for j in range(1, words):
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key += h[j:j + n]
    key = np.sort(_mix(key))
    return key[np.concatenate([[True], key[1:] != key[:-1]])]


def class_of(found: np.ndarray) -> int:
    """Equal sets, and only those, have equal class ids (64-bit digest)."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def prefix(found: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    size = len(found) - -(-percent * len(found) // 100) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        late = common[at] == found
        found = np.concatenate([found[~late], found[late]])
    return found[:size]


def wide_map(found: np.ndarray) -> bytes:
    """A bitmap of at least four bits per shingle; its length is a power of two."""
    size = max(BITS, 1 << (4 * len(found) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(found % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap that a smaller power of two gives: parts laid over each other."""
    return np.bitwise_or.reduce(bits.reshape(-1, size // 8), axis=0)


def signature(found: np.ndarray) -> bytes:
    return folded(np.frombuffer(wide_map(found), np.uint8), BITS).tobytes()


def links(overlap, sizes, percent: int = PERCENT):
    """percent of the union at least: 100 * overlap >= percent * (sizes - overlap)."""
    return (100 + percent) * overlap >= percent * sizes


class SignatureTree:
    """A packed tree over classes, sorted by side, component and size so that nodes are alike.

    With two sides only pairs across them count. ``firsts`` holds the smallest keys of each class:
    a pair that shares one below ``key`` is left to that key.
    """

    def __init__(self, ids, sizes, labels, maps, sides=None, firsts=None, key=None):
        sides = np.zeros(len(ids), np.int8) if sides is None else sides
        order = np.lexsort((ids, sizes, labels, sides))
        self.ids, self.sizes, self.labels, self.sides = ids[order], sizes[order], labels[order], sides[order]
        self.maps = np.ascontiguousarray(maps[order]).view(np.uint64)
        self.firsts, self.key = None if firsts is None else firsts[order], key
        self.across = bool(len(ids)) and self.sides[0] != self.sides[-1]
        slack = self.sizes - np.bitwise_count(self.maps).sum(1)
        n = len(order)
        cuts = np.arange(0, n, LEAF)
        level = [np.minimum.reduceat(self.sizes, cuts), np.maximum.reduceat(self.sizes, cuts),
                 np.minimum.reduceat(self.labels, cuts), np.maximum.reduceat(self.labels, cuts),
                 np.maximum.reduceat(slack, cuts), np.bitwise_or.reduceat(self.maps, cuts),
                 np.minimum.reduceat(self.sides, cuts), np.maximum.reduceat(self.sides, cuts)]
        self.levels = [level]
        while len(level[0]) > 1:
            cuts = np.arange(0, len(level[0]), FANOUT)
            tools = (np.minimum, np.maximum, np.minimum, np.maximum, np.maximum, np.bitwise_or,
                     np.minimum, np.maximum)
            level = [tool.reduceat(values, cuts) for tool, values in zip(tools, level)]
            self.levels.append(level)

    def _may_link(self, level: int, a: int, b: int, percent: int) -> bool:
        low, high, first, last, slack, maps, near, far = self.levels[level]
        if first[a] == last[a] == first[b] == last[b]:
            return False  # one component already
        if self.across and near[a] == far[a] == near[b] == far[b]:
            return False  # one side
        if 100 * high[a] < percent * low[b] or 100 * high[b] < percent * low[a]:
            return False
        shared = int(np.bitwise_count(maps[a] & maps[b]).sum())
        overlap = min(high[a], high[b], slack[a] + shared, slack[b] + shared)
        return links(overlap, low[a] + low[b], percent)

    def pairs(self, percent: int = PERCENT):
        """Index pairs of different components that may link."""
        top = len(self.levels) - 1
        stack = [(top, a, b) for a in range(len(self.levels[top][0])) for b in range(a, len(self.levels[top][0]))]
        while stack:
            level, a, b = stack.pop()
            if not self._may_link(level, a, b, percent):
                continue
            if level:
                n = len(self.levels[level - 1][0])
                left = range(a * FANOUT, min(n, (a + 1) * FANOUT))
                right = range(b * FANOUT, min(n, (b + 1) * FANOUT))
                stack += [(level - 1, x, y) for x in left for y in right if a != b or x <= y]
            else:
                yield from self._leaf(a, b, percent)

    def _leaf(self, a: int, b: int, percent: int):
        x, y = slice(a * LEAF, (a + 1) * LEAF), slice(b * LEAF, (b + 1) * LEAF)
        here, there = self.maps[x][:, None], self.maps[y][None]
        n, m = self.sizes[x][:, None], self.sizes[y][None]
        overlap = np.minimum(n - np.bitwise_count(here & ~there).sum(2), m - np.bitwise_count(there & ~here).sum(2))
        fits = links(overlap, n + m, percent) & (self.labels[x][:, None] != self.labels[y][None])
        if self.across:
            fits &= self.sides[x][:, None] != self.sides[y][None]
        if a == b:
            fits &= np.triu(np.ones(fits.shape, bool), 1)
        i, j = np.nonzero(fits)
        i, j = i + a * LEAF, j + b * LEAF
        if self.firsts is not None and len(i):
            p, q = self.firsts[i], self.firsts[j]
            seen = ((p[:, :, None] == q[:, None, :]) & (p < self.key)[:, :, None]).any((1, 2))
            i, j = i[~seen], j[~seen]
        yield from zip(i.tolist(), j.tolist())


def leaf_pairs(cell, key, ids, sizes, labels, sides, firsts, maps, percent: int = PERCENT):
    """Arrays (a, b) of what single leaves give: the same pairs as a tree per cell, many cells at once.

    Rows of a cell lie together and ``cell`` numbers them; no cell has more than LEAF rows.
    """
    maps = np.ascontiguousarray(maps).view(np.uint64)
    slack = sizes - np.bitwise_count(maps).sum(1)
    starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
    across = np.zeros(cell[-1] + 1, bool)
    across[cell[starts]] = np.minimum.reduceat(sides, starts) != np.maximum.reduceat(sides, starts)
    for step in range(1, LEAF):
        i = np.flatnonzero(cell[:-step] == cell[step:])
        if not len(i):
            break
        j = i + step
        n, m = sizes[i], sizes[j]
        fits = links(np.minimum(n, m), n + m, percent) & (labels[i] != labels[j])
        fits &= ~across[cell[i]] | (sides[i] != sides[j])
        i, j = i[fits], j[fits]
        shared = np.bitwise_count(maps[i] & maps[j]).sum(1, dtype=np.int64)
        # Every bit of one that the other lacks is a shingle that the other lacks.
        fits = links(shared + np.minimum(slack[i], slack[j]), sizes[i] + sizes[j], percent)
        i, j = i[fits], j[fits]
        p, q = firsts[i], firsts[j]
        seen = ((p[:, :, None] == q[:, None, :]) & (p < key[i][:, None])[:, :, None]).any((1, 2))
        i, j = ids[i[~seen]], ids[j[~seen]]
        yield np.minimum(i, j), np.maximum(i, j)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _common(source: DataFrame, words: int) -> np.ndarray:
    chosen = source.where(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 20)) < int(ORDER_SHARE * (1 << 20)))

    def run(batches):
        for batch in batches:
            found = [shingles(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64))], names=["s"])

    often = (chosen.select("text").mapInArrow(run, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= COMMON_FROM).orderBy(F.desc("n"), "s").limit(COMMON_MOST).collect())
    return np.sort(np.array([r["s"] for r in often], np.int64).view(np.uint64))


def _announced(source: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """(key, class_id) of every class's prefix; copies within a task announce once."""
    def run(batches):
        done, keys, owners = set(), [], []

        def sent():
            rows = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], names=["key", "class_id"])
            keys.clear()
            owners.clear()
            return rows

        size = 0
        for batch in batches:
            for text in batch.column("text"):
                found = shingles(text.as_py(), words)
                own = class_of(found)
                if len(found) and own not in done:
                    done.add(own)
                    keys.append(prefix(found, common, percent).view(np.int64))
                    owners.append(np.full(len(keys[-1]), own, np.int64))
                    size += 2 * keys[-1].nbytes
                    if size > SEND_BYTES:
                        size = 0
                        yield sent()
        if keys:
            yield sent()

    return source.select("text").mapInArrow(run, "key long, class_id long")


def _shared(announced: DataFrame) -> DataFrame:
    """Those (key, class_id) whose key has two classes at least; groups stream through in order."""
    def run(batches):
        last = None  # the row before: its key, its class, whether it went out
        for batch in batches:
            key, own = (batch.column(i).to_numpy() for i in range(2))
            if not len(key):
                continue
            if last is not None:
                key, own = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], own])
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
            if last is not None:
                first_out = last[2]
            at = np.flatnonzero(new)
            k, o = key[at], own[at]
            same = np.zeros(len(k), bool)
            same[1:] = k[1:] == k[:-1]
            keep = same.copy()
            keep[:-1] |= same[1:]
            sent = keep.copy()
            if last is not None:
                sent[0] = keep[0] and not first_out
            yield pa.RecordBatch.from_arrays([pa.array(k[sent]), pa.array(o[sent])], names=["key", "class_id"])
            last = k[-1], o[-1], bool(keep[-1]) or (last is not None and len(k) == 1 and first_out)

    schema = "key long, class_id long"
    return announced.repartition("key").sortWithinPartitions("key", "class_id").mapInArrow(run, schema)


def _wanted(shared: DataFrame) -> np.ndarray:
    """A fixed-size bit map of the classes that share a key; the driver sees at most FILTER_BITS bits."""
    spot = F.pmod(F.col("class_id"), F.lit(FILTER_BITS)) + 1  # the functions count positions from 1
    rows = (shared.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for row in rows:
        at = 4096 * (row["bucket"] - 1)
        bits[at:at + 4096] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


_DOCS = "doc_id long, text_hash long, n long, class_id long, bits binary"


def _documents(source: DataFrame, wanted: np.ndarray, words: int) -> DataFrame:
    """Every document's class; its wide bitmap where the class may share a key, once per task."""
    def run(batches):
        done = set()
        for batch in batches:
            n, owners, maps, size, start = [], [], [], 0, 0
            for at, text in enumerate(batch.column("text"), 1):
                found = shingles(text.as_py(), words)
                own = class_of(found)
                ask = len(found) and own not in done and _has(wanted, own % FILTER_BITS)
                if ask:
                    done.add(own)
                n.append(len(found))
                owners.append(own)
                maps.append(wide_map(found) if ask else None)
                size += len(maps[-1] or b"")
                if at == batch.num_rows or size > SEND_BYTES:
                    rows = batch.slice(start, at - start)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), rows.column("text_hash"), pa.array(n, pa.int64()),
                         pa.array(owners, pa.int64()), pa.array(maps, pa.binary())],
                        names=["doc_id", "text_hash", "n", "class_id", "bits"])
                    n, owners, maps, size, start = [], [], [], 0, at

    return source.mapInArrow(run, _DOCS)


def _sets(source: DataFrame, documents: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(class_id, found) of the classes in the pairs; others only by accident of the filter.

    One text of each class is chosen by its hash, so other texts aren't cut into shingles.
    """
    used = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    chosen = documents.join(used, "class_id").groupBy("class_id").agg(F.min("text_hash").alias("text_hash"))
    wanted = _wanted(chosen.select(F.col("text_hash").alias("class_id")))

    def run(batches):
        done = set()
        for batch in batches:
            owners, sets, size = [], [], 0
            for key, text in zip(batch.column("text_hash").to_pylist(), batch.column("text")):
                if key in done or not _has(wanted, key % FILTER_BITS):
                    continue
                done.add(key)
                found = shingles(text.as_py(), words)
                if len(found):
                    owners.append(class_of(found))
                    sets.append(found.tobytes())
                    size += found.nbytes
                if size > SEND_BYTES:
                    yield _batch(list(zip(owners, sets)), ["class_id", "found"], [pa.int64(), pa.binary()])
                    owners, sets, size = [], [], 0
            yield _batch(list(zip(owners, sets)), ["class_id", "found"], [pa.int64(), pa.binary()])

    rows = source.select("text_hash", "text").mapInArrow(run, "class_id long, found binary")
    return rows.groupBy("class_id").agg(F.first("found").alias("found"))


def _has(bits: np.ndarray, spot: int) -> bool:
    return bool(bits[spot >> 3] >> (spot & 7) & 1)


def _with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the column of either class as x and y."""
    left = table.select(F.col("class_id").alias("a"), F.col(column).alias("x"))
    right = table.select(F.col("class_id").alias("b"), F.col(column).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and wide bitmaps leave possible."""
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                n, m = x["n"], y["n"]
                p, q = (np.frombuffer(v["bits"], np.uint8) for v in (x, y))
                size = 8 * min(len(p), len(q))
                p, q = folded(p, size), folded(q, size)
                shared = int(np.bitwise_count(p & q).sum())
                # Every bit of one that the other lacks is a shingle that the other lacks.
                overlap = shared + min(n - int(np.bitwise_count(p).sum()), m - int(np.bitwise_count(q).sum()))
                good.append(links(overlap, n + m, percent))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    rows = maps.select("class_id", F.struct("n", "bits").alias("map"))
    return _with_both(pairs, rows, "map").mapInArrow(run, "a long, b long")


def _verified(source: DataFrame, documents: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                good.append(bool(links(int((y[at] == x).sum()), len(x) + len(y), percent)))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return _with_both(pairs, _sets(source, documents, pairs, words), "found").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(class_id, label) of every class in the edges; the smallest class id that links reach.

    Labels spread to neighbours and jump to their label's label until nothing changes.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("class_id")).agg(
        F.least(F.col("class_id"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.class_id).groupBy("a").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("class_id").alias("at"), F.col("label").alias("further"))
        new = (labels.join(near, labels.class_id == near.a).join(jump, labels.label == jump.at)
               .select("class_id", F.col("label").alias("old"),
                       F.least("label", "near", "further").alias("label")))
        new = written(new, "labels")
        if new.where("label < old").isEmpty():
            return new.select("class_id", "label")
        labels = new.select("class_id", "label")


def _led(groups: DataFrame, seeds: list[int]) -> DataFrame:
    """A pair per class and seed: of the leaders of its (key, size range) groups, chosen by seeded hash,
    the one it shares most keys with."""
    leaders = [F.struct(F.lit(seed).alias("seed"),
                        F.min_by("class_id", F.xxhash64(F.lit(seed), "class_id")).alias("leader")) for seed in seeds]
    chosen = groups.groupBy("key", "range").agg(F.array(*leaders).alias("led"))
    shared = groups.join(chosen, ["key", "range"]).select("class_id", F.inline("led")).where(
        "leader <> class_id").groupBy("class_id", "seed", "leader").agg(F.count(F.lit(1)).alias("keys"))
    best = shared.groupBy("class_id", "seed").agg(F.max_by("leader", F.struct("keys", "leader")).alias("leader"))
    return best.select(F.least("leader", "class_id").alias("a"), F.greatest("leader", "class_id").alias("b")).distinct()


def _cells(rows: DataFrame, block: int) -> DataFrame:
    """The rows with their cell and side; of a key with more than ``block`` rows, one for each cell.

    Blocks of such a key are (size range, hash) and hold about ``block`` rows; cells are a block
    with itself and pairs of blocks of one or of neighbouring size ranges, others can't link.
    """
    large = rows.where(F.col("total") > block)
    counts = large.groupBy("key", "range").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    parts = counts.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("range", "parts"))).alias("parts"))
    r, own = F.col("range"), F.pmod(F.xxhash64("class_id"), F.col("parts")[F.col("range")])

    def cell(low, i, high, j, side):
        return F.struct(F.xxhash64(low, i, high, j).alias("cell"), side.cast("int").alias("side"))

    def others(shift, make):
        last = F.coalesce(F.try_element_at("parts", r + shift), F.lit(0)) - 1
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), last), make)).otherwise(F.array())

    cells = F.concat(
        others(0, lambda j: cell(r, F.least(own, j), r, F.greatest(own, j), j < own)),
        others(1, lambda j: cell(r, own, r + 1, j, F.lit(0))),
        others(-1, lambda j: cell(r - 1, j, r, own, F.lit(1))))
    names = ["key", "class_id", "n", "label"]
    dealt = large.join(parts, "key").select(*names, F.inline(cells))
    small = rows.where(F.col("total") <= block).select(*names, F.lit(0).cast("long").alias("cell"),
                                                       F.lit(0).alias("side"))
    return small.unionByName(dealt)


def _rest(groups: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that a signature tree per cell can't rule out."""
    def tree_pairs(key, rows):
        ids, sizes, labels, sides, firsts, maps = (np.concatenate(c) for c in zip(*rows))
        tree = SignatureTree(ids, sizes, labels, maps, sides, firsts, key)
        for i, j in tree.pairs(percent):
            a, b = int(tree.ids[i]), int(tree.ids[j])
            yield (a, b) if a < b else (b, a)

    def run(batches):
        held, current = [], None
        out: set = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cell, own, size, label, side = (
                batch.column(c).to_numpy() for c in ("key", "cell", "class_id", "n", "label", "side"))
            maps = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(-1, BITS // 8)
            firsts = batch.column("firsts").flatten().to_numpy().reshape(-1, FIRSTS)
            new = (np.diff(key, prepend=key[:1] - 1) != 0) | (np.diff(cell, prepend=cell[:1]) != 0)
            cuts = np.flatnonzero(new)
            ends = np.append(cuts[1:], len(key))
            # Small cells that surely begin and end in this batch; others are held until they end.
            whole = (ends - cuts <= LEAF) & (ends < len(key)) & (cuts > 0)
            small = np.repeat(whole, ends - cuts)
            if small.any():
                number = np.repeat(np.arange(len(cuts)), ends - cuts)
                rows = (c[small] for c in (number, key, own, size, label, side, firsts, maps))
                for a, b in leaf_pairs(*rows, percent):
                    out.update(zip(a.tolist(), b.tolist()))
            for x, y in zip(cuts[~whole].tolist(), ends[~whole].tolist()):
                if (key[x], cell[x]) != current:
                    if held:
                        out.update(tree_pairs(current[0], held))
                    held, current = [], (key[x], cell[x])
                held.append((own[x:y], size[x:y], label[x:y], side[x:y], firsts[x:y], maps[x:y]))
                if len(out) > 100_000:
                    yield _batch(list(out), ["a", "b"], [pa.int64()] * 2)
                    out = set()
        if held:
            out.update(tree_pairs(current[0], held))
        yield _batch(list(out), ["a", "b"], [pa.int64()] * 2)

    @F.pandas_udf("binary")
    def narrow(bits):
        return bits.map(lambda raw: folded(np.frombuffer(raw, np.uint8), BITS).tobytes())

    least = F.slice(F.array_sort(F.collect_set("key")), 1, FIRSTS)
    firsts = groups.groupBy("class_id").agg(least.alias("firsts")).select("class_id", F.concat(
        "firsts", F.array_repeat(F.lit(NO_KEY), FIRSTS - F.size("firsts"))).alias("firsts"))
    known = firsts.join(maps.select("class_id", narrow("bits").alias("bits")), "class_id")
    rows = _cells(groups, BLOCK).join(known, "class_id")
    return (rows.repartition("key", "cell").sortWithinPartitions("key", "cell")
            .mapInArrow(run, "a long, b long").distinct())


def _unsettled(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of keys that still hold more than one component, with their labels and the key's total."""
    if labels is None:
        named = groups.withColumn("label", F.col("class_id"))
    else:
        named = groups.join(labels, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    open_keys = named.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("total"))
    return named.join(open_keys.where("low < high").select("key", "total"), "key")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) that aren't one component yet."""
    a = labels.select(F.col("class_id").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("class_id").alias("b"), F.col("label").alias("lb"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_hash, n_shingles, component (an opaque number), component_id.

    Two documents link when percent of the union of their shingle sets is in both;
    ``component_id`` is the smallest doc_id that links reach. A text of fewer words than a
    shingle is one shingle; a null text or one without words links with nothing and is
    its own component (``component`` is null). Rows that repeat are documents; null ids
    are passed over for component_id while there is another.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                         F.col(text).alias("text"))
    with batches_by_bytes(docs.sparkSession):
        return _linked(source, words, percent)


def _linked(source: DataFrame, words: int, percent: int) -> DataFrame:
    common = _common(source, words)
    shared = written(_shared(_announced(source, common, words, percent)), "shared")
    documents = written(_documents(source, _wanted(shared), words), "documents")
    maps = written(documents.where(F.col("bits").isNotNull()).groupBy("class_id").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits")), "maps")
    # A little more than the largest ratio of sizes that link: they stand in one or in neighbouring ranges.
    step = 1.000001 * float(np.log(100 / min(percent, 99)))
    sizes = maps.select("class_id", "n", F.floor(F.log("n") / step).alias("range"))
    groups = written(shared.join(sizes, "class_id"), "groups")
    edges, labels, tried = None, None, None
    for turn in range(ROUNDS):
        groups_now = groups if labels is None else _unsettled(groups, labels)
        led = _led(groups_now, [LEADERS * turn + i for i in range(LEADERS)])
        if tried is not None:
            led = _apart(led, labels).join(tried, ["a", "b"], "left_anti")
        pairs = written(_bounded(led, maps, percent), "pairs")
        if pairs.isEmpty():
            break
        new = written(_verified(source, documents, pairs, words, percent), "links")
        tried = pairs if tried is None else tried.union(pairs)
        edges = new if edges is None else edges.union(new)
        if new.isEmpty():
            break
        labels = components(edges)

    left = written(_unsettled(groups, labels), "unsettled")
    rest = written(_rest(left, maps, percent), "candidates")
    rest = _bounded(rest, maps, percent)
    if tried is not None:
        rest = rest.join(tried, ["a", "b"], "left_anti")
    new = written(_verified(source, documents, written(rest, "pairs"), words, percent), "links")
    labels = components(new if edges is None else edges.union(new))
    rows = documents.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "class_id").join(
        labels, "class_id", "left")
    rows = rows.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("label", "class_id")))
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least, "component", "left")
    return rows.select("doc_id", "text_hash", "n_shingles", "component",
                       F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
                       .alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """The documents of which one per component stays, the one with the smallest id (then text hash).

    A null id stays only where there is no other. Documents without words all stay. Of
    fully repeated rows one stays.
    """
    linked = link(docs, words, percent, doc_id, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    kept = linked.where("component is not null").groupBy("component").agg(first.alias("it")).select(
        F.xxhash64("it.doc_id", "it.text_hash").alias("_key"))
    key = F.xxhash64(F.col(doc_id).cast("long"), F.xxhash64(F.col(text)))
    rows = docs.select(F.struct("*").alias("row"), key.alias("_key"))
    wordless = ~F.coalesce(F.col(f"row.`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # One key for the join and for repeated rows: the texts are shuffled once.
    chosen = rows.where(~wordless).join(kept, "_key", "left_semi").dropDuplicates(["_key"])
    return chosen.select("row.*").unionByName(rows.where(wordless).select("row.*"))
