"""Deleted interpolation: n-gram estimates mixed by how often their context was seen.

Documents are dealt into blocks of bounded text. A block counts its own n-grams and sends
each distinct one, as a 64-bit hash with its count, to the bucket that owns the hash; the
bucket adds up and answers every block that asked. So no row per token is shuffled, a
frequent n-gram is one entry per block, and no task holds more than a block or a bucket.
A tenth of the training documents (remainder 1) has blocks of its own: counts without
them and the counts in them are what expectation-maximisation learns the weights from.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import byte_words, text_blocks, written

ORDER = 2
BLOCK_BYTES = 16 << 20
FOLDS, HELD_OUT, TUNING = 10, 0, 1
#: Steps of log2 to which probabilities are rounded before the driver sees their histogram.
STEPS = 4
NEVER = -10_000
END = b" "  # no word contains a space
_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Block:
    """The tokens of some texts: hashes of the n-grams that end at each token, by length."""

    def __init__(self, texts: list, order: int):
        codes: dict[bytes, int] = {END: 0}
        ids, ends = [], []
        total = 0
        for text in texts:
            words = byte_words(text, lower=True)
            ids.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int32, len(words)))
            ids.append(np.zeros(1, np.int32))
            total += len(words) + 1
            ends.append(total)
        self.ends = np.array(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        tokens = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in codes], np.uint64)
        here = hashes[tokens]
        self.doc = np.repeat(np.arange(len(texts)), self.ends - self.starts)
        place = np.arange(len(tokens)) - self.starts[self.doc] if len(tokens) else tokens
        self.first = place == 0
        self.keys, self.where = [], []
        key = here
        for k in range(order):
            if k:  # one more token of history; before the text stands the end
                past = np.where(place >= k, np.roll(here, k), hashes[0])
                key = _mix(key + past * np.uint64(2 * k + 1))
            distinct, where = np.unique(key, return_inverse=True)
            self.keys.append(distinct)
            self.where.append(where)

    def counts(self, used: np.ndarray) -> list[np.ndarray]:
        """How often each distinct n-gram ends in the documents that ``used`` marks."""
        weight = used[self.doc].astype(float)
        return [np.bincount(w, weight, len(k)).astype(np.int64) for k, w in zip(self.keys, self.where)]


def _planes(values: np.ndarray) -> bytes:
    """Differences of sorted hashes, byte by byte of equal rank: the high bytes compress away."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _narrow(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs; the first byte says how many."""
    top = int(values.max()) if len(values) else 0
    size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _table(rows: list[tuple], fields: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    named = [f.split() for f in fields.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in named]
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, named)], names=[n for n, _ in named])


def _lookup(rows: pa.Table, order: int, column: str) -> list[np.ndarray]:
    """A block's counts, put together from the buckets' answers in the order of its keys."""
    rows = rows.sort_by([("size", "ascending"), ("bucket", "ascending")])
    sizes = rows.column("size").to_pylist()
    parts = [_wide(b) for b in rows.column(column).to_pylist()]
    return [np.concatenate([p for p, s in zip(parts, sizes) if s == k + 1] or [np.zeros(0, np.int64)])
            for k in range(order)]


def _estimates(block: Block, counts: list[np.ndarray], tokens: int, docs: int):
    """Per token: its own count, the bucket of its longest context, and each length's estimate."""
    seen = [c[w] for c, w in zip(counts, block.where)]
    parts, context = [], None
    for k, own in enumerate(seen):
        if k == 0:
            context = np.full(len(own), tokens, np.int64)
        else:  # the context of a document's first token is the start, seen once per document
            context = np.where(block.first, docs, np.roll(seen[k - 1], 1))
        parts.append(own / np.maximum(context, 1))
    bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)
    return seen[0], bucket, parts


def weights_from(histogram: list[tuple], floor: float, order: int, rounds: int = 100) -> tuple[dict, list]:
    """Mixture weights per bucket by expectation-maximisation, and those of all buckets together.

    A row is (bucket, rounded log2 of each length's estimate, tokens). Weights are in the
    order lengths 1.., then the uniform floor, which never gets less than a thousandth.
    """
    def learn(rows):
        p = np.array([[0.0 if q == NEVER else 2.0 ** (q / STEPS) for q in r[1:-1]] + [floor] for r in rows])
        n = np.array([r[-1] for r in rows], float)
        share = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            mixed = p * share
            got = (mixed / mixed.sum(1, keepdims=True) * n[:, None]).sum(0)
            new = np.maximum(got / n.sum(), 1e-3 / (order + 1))
            new /= new.sum()
            if np.abs(new - share).max() < 1e-9:
                break
            share = new
        return share.tolist()

    everything = learn(histogram) if histogram else [1 / (order + 1)] * (order + 1)
    groups: dict[int, list] = {}
    for row in sorted(histogram):
        groups.setdefault(row[0], []).append(row)
    return {b: learn(rows) for b, rows in groups.items()}, everything


def score(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32(doc_id as text) mod 10 is not 0; a null id
    counts as the empty text, so it is held out. A null or empty text is its end token
    alone. Repeated rows are documents of their own. ``score`` is the log10 probability
    of the text under the mixture. Other columns are ignored.
    """
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                         fold.cast("int").alias("fold"))
    blocks = text_blocks(source, "text", block_bytes)
    tuning = max(1, math.ceil(blocks / (FOLDS - 1)))
    dealt = F.xxhash64("doc_id", "text")
    source = source.withColumn("block", F.when(
        F.col("fold") == TUNING, blocks + F.pmod(dealt, F.lit(tuning))).otherwise(F.pmod(dealt, F.lit(blocks))))
    edges = np.array([(i << 64) // blocks for i in range(1, blocks)], np.uint64)
    sent = "size int, bucket int, block long, grams binary, n binary"

    def send(key, rows):
        here = Block(rows.column("text").to_pylist(), order)
        used = rows.column("fold").to_numpy() != HELD_OUT
        out = []
        for k, (keys, n) in enumerate(zip(here.keys, here.counts(used))):
            cuts = [0, *np.searchsorted(keys, edges, "left").tolist(), len(keys)]
            out += [(k + 1, b, key[0].as_py(), _planes(keys[x:y]), _narrow(n[x:y]))
                    for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        return _table(out, sent)

    answers = "block long, size int, bucket int, n binary, fitted binary, distinct long, total long"

    def add_up(key, rows):
        size, bucket = key[0].as_py(), key[1].as_py()
        keys = [_unplanes(b) for b in rows.column("grams").to_pylist()]
        counts = [_wide(b) for b in rows.column("n").to_pylist()]
        owner = rows.column("block").to_pylist()
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        late = np.repeat([o >= blocks for o in owner], [len(k) for k in keys])
        everything = np.concatenate(counts).astype(float)
        total = np.bincount(where, everything, len(distinct)).astype(np.int64)
        fitted = np.bincount(where, everything * ~late, len(distinct)).astype(np.int64)
        out, at = [(-1, size, bucket, None, None, int((total > 0).sum()), int(total.sum())),
                   (-2, size, bucket, None, None, int((fitted > 0).sum()), int(fitted.sum()))], 0
        for o, k in zip(owner, keys):
            mine = where[at:at + len(k)]
            at += len(k)
            out.append((o, size, bucket, _narrow(total[mine]), _narrow(fitted[mine]) if o >= blocks else None, 0, 0))
        return _table(out, answers)

    counts = written(source.groupBy("block").applyInArrow(send, sent)
                     .groupBy("size", "bucket").applyInArrow(add_up, answers), "ngrams")
    totals = {r["block"]: r for r in counts.where("block < 0 and size = 1").groupBy("block").agg(
        F.sum("distinct").alias("v"), F.sum("total").alias("n")).collect()}
    sizes = {r["fit"]: r["n"] for r in source.where(F.col("fold") != HELD_OUT).groupBy(
        (F.col("fold") != TUNING).alias("fit")).agg(F.count(F.lit(1)).alias("n")).collect()}
    words, tokens = (totals[-1]["v"], totals[-1]["n"]) if totals else (0, 0)
    fit_tokens, fit_docs = (totals[-2]["n"] if totals else 0), sizes.get(True, 0)
    train_docs, floor = sum(sizes.values()), 1 / (words + 1)
    asked = counts.where("block >= 0").select("block", "size", "bucket", "n", "fitted")

    figures = ", ".join(["bucket long", *(f"p{k} long" for k in range(1, order + 1)), "tokens long"])

    def histogram(key, rows, found):
        here = Block(rows.column("text").to_pylist(), order)
        _, bucket, parts = _estimates(here, _lookup(found, order, "fitted"), fit_tokens, fit_docs)
        rounded = [np.where(p > 0, np.rint(STEPS * np.log2(np.maximum(p, 1e-300))), NEVER).astype(np.int64)
                   for p in parts]
        kinds, n = np.unique(np.stack([bucket, *rounded], axis=1), axis=0, return_counts=True)
        return _table([(*row, c) for row, c in zip(kinds.tolist(), n.tolist())], figures)

    late = source.where(F.col("fold") == TUNING).groupBy("block").cogroup(
        asked.where(F.col("block") >= blocks).groupBy("block")).applyInArrow(histogram, figures)
    names = [f.split()[0] for f in figures.split(", ")]
    seen = [tuple(r) for r in late.groupBy(names[:-1]).agg(F.sum("tokens").alias("tokens")).collect()]
    by_bucket, everything = weights_from(seen, floor, order)
    table = np.array([by_bucket.get(b, everything) for b in range(65)])

    def rate(key, rows, found):
        here = Block(rows.column("text").to_pylist(), order)
        own, bucket, parts = _estimates(here, _lookup(found, order, "n"), tokens, train_docs)
        share = table[bucket]
        mixed = sum((share[:, k] * p for k, p in enumerate(parts)), share[:, -1] * floor)
        base = np.log10((own + 0.1) / (tokens + 0.1 * (words + 1)))
        size = here.ends - here.starts
        return pa.table({
            "doc_id": rows.column("doc_id"),
            "held_out": pa.array(rows.column("fold").to_numpy() == HELD_OUT),
            "n_tokens": pa.array(size),
            "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), here.starts)),
            "train_tokens": pa.array(np.full(len(size), tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, here.starts)),
            "score": pa.array(np.add.reduceat(np.log10(mixed), here.starts))})

    return source.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(rate, _SCORES)
