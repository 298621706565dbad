"""Token ids in files: canonical, length-limited Huffman codes in independent blocks.

Layout below the given folder: ``codes`` holds one file with a code length per id (the
canonical code follows from the lengths); ``blocks`` holds files in ascending document
order. A file is a run of blocks, each followed by a line feed. A block, little-endian:

    4 bytes  b"HCB1"
    u32 x 4  documents, ids, checkpoints, payload bytes
    i64      ids of all documents before the block
    i64 x documents    document ids (the smallest i64 stands for null)
    u32 x documents    ids per document
    u32 x checkpoints  bit offset of every EVERY-th id
    payload            codes, most significant bit first, in 32-bit big-endian words
    u32                crc32 of all that precedes

A reader may start at any block, and inside it at any checkpoint.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.llm.common import batches_by_bytes, text_blocks, written
from tonegauge.llm.tokens import default_tokenizer, encoder

MAGIC, HEAD = b"HCB1", struct.Struct("<4s4Iq")
LIMIT, EVERY = 20, 256
NULL_ID = -(1 << 63)
BLOCK_IDS, FILE_BLOCKS, FILE_TEXT = 65_536, 256, 32 << 20
LANE_BLOCKS = 64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per symbol of an optimal code of at most ``limit`` bits, 0 where the count is 0.

    Package-merge: each level pairs up the cheapest items of the level below and merges the
    pairs with the symbols; the first 2n - 2 items of the last level say how often each
    symbol is taken.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = np.asarray(counts)[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = len(level) // 2
        items = np.concatenate([leaves, level[0:2 * pairs:2] + level[1:2 * pairs:2]])
        rank = np.argsort(items, kind="stable")
        level = items[rank]
        is_leaf.append(rank < len(leaves))
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = bits
    return lengths


class Code:
    """The canonical code of the given lengths; short codes first, equal lengths by symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        used = np.flatnonzero(lengths)
        self.symbols = used[np.argsort(lengths[used], kind="stable")].astype(np.uint32)
        bits = self.lengths[self.symbols].astype(np.int64)
        self.limit = int(bits.max()) if len(bits) else 1
        span = 1 << (self.limit - bits)
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.symbols] = (np.cumsum(span) - span) >> (self.limit - bits)
        self.span = span
        self._table = None

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbol and the code length for each possible next ``limit`` bits."""
        if self._table is None:
            symbol = np.zeros(1 << self.limit, np.uint32)
            filled = np.repeat(self.symbols, self.span)
            symbol[:len(filled)] = filled
            self._table = symbol, self.lengths[symbol].astype(np.int64)
        return self._table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Packed bits and the bit offset of every EVERY-th id."""
        size = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(size)
        at = ends - size
        room = (64 - (at & 31) - size).astype(np.uint64)
        both = self.codes[ids] << room
        words, last = at >> 5, (int(ends[-1]) + 31 >> 5) if len(ids) else 0
        # Codes share words but no bits, so sums (exact below 2**53) set the bits.
        high = np.bincount(words, (both >> np.uint64(32)).astype(float), last + 1)
        low = np.bincount(words + 1, (both & np.uint64(0xFFFFFFFF)).astype(float), last + 1)
        packed = (high[:last] + low[:last]).astype(">u4").tobytes()
        return packed, at[::EVERY].astype("<u4")

    def decode(self, payload: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of all lanes, one after the other. A lane starts at a checkpoint; lanes advance together."""
        if not len(starts):
            return np.zeros(0, np.uint32)
        symbol, size = self.table
        words = np.frombuffer(payload + b"\0" * 8, ">u4", len(payload) // 4 + 2).astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        order = np.argsort(-counts, kind="stable")
        at, left = starts[order].astype(np.int64), counts[order]
        out = np.zeros((len(at), int(left[0])), np.uint32)
        shift = np.uint64(64 - self.limit)
        for step in range(int(left[0])):
            lanes = int(np.searchsorted(-left, -step, "left"))
            now = at[:lanes]
            seen = (pairs[now >> 5] << (now & 31).astype(np.uint64)) >> shift
            out[:lanes, step] = symbol[seen]
            now += size[seen]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out[back][np.arange(out.shape[1]) < counts[:, None]]


def write_block(code: Code, doc_ids: list, parts: list[np.ndarray], before: int) -> bytes:
    ids = np.concatenate(parts)
    payload, checkpoints = code.encode(ids)
    keys = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    body = b"".join([
        HEAD.pack(MAGIC, len(parts), len(ids), len(checkpoints), len(payload), before), keys.tobytes(),
        np.array([len(p) for p in parts], "<u4").tobytes(), checkpoints.tobytes(), payload])
    return body + struct.pack("<I", zlib.crc32(body))


def read_blocks(code: Code, content: bytes):
    """Per block: document ids, ids per document, ids before the block, all its ids.

    The lanes of up to LANE_BLOCKS blocks are decoded together.
    """
    at, held = 0, []
    while at < len(content):
        magic, docs, n, marks, size, before = HEAD.unpack_from(content, at)
        end = at + HEAD.size + 12 * docs + 4 * marks + size
        if magic != MAGIC or zlib.crc32(content[at:end]) != struct.unpack_from("<I", content, end)[0]:
            raise ValueError(f"damaged block at byte {at}")
        p = at + HEAD.size
        keys = np.frombuffer(content, "<i8", docs, p)
        lengths = np.frombuffer(content, "<u4", docs, p + 8 * docs).astype(np.int64)
        starts = np.frombuffer(content, "<u4", marks, p + 12 * docs).astype(np.int64)
        counts = np.full(marks, EVERY, np.int64)
        counts[-1:] = n - EVERY * (marks - 1)
        held.append((keys, lengths, before, starts, counts, content[end - size:end]))
        at = end + 5
        if len(held) == LANE_BLOCKS or at >= len(content):
            shift = np.cumsum([0, *(8 * len(h[5]) for h in held)])
            ids = code.decode(b"".join(h[5] for h in held),
                              np.concatenate([h[3] + s for h, s in zip(held, shift)]),
                              np.concatenate([h[4] for h in held]))
            cuts = np.cumsum([h[4].sum() for h in held])[:-1]
            yield from ((*h[:3], part) for h, part in zip(held, np.split(ids, cuts)))
            held = []


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = 1,
                 limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes whole texts, each followed by the id ``end``, into files below ``path``.

    Documents are in ascending order of doc_id, nulls first; repeated ids by their text's
    ids. A null or empty text is its end id alone. Other columns are ignored. An empty
    table makes files without blocks.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with batches_by_bytes(docs.sparkSession):
        _write(source, path, tokenizer or default_tokenizer(), end, limit)


def _write(source: DataFrame, path: str, tokenizer: str, end: int, limit: int) -> None:
    parts = text_blocks(source, "text", FILE_TEXT)
    # Bounds only deal the documents out evenly; the order is exact whatever they are.
    bounds = source.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.5 / parts) if parts > 1 else []
    bounds = np.array(sorted(set(map(int, bounds))), np.int64)

    def tokenise(batches):
        enc = encoder(tokenizer)
        small = enc.tokenizer.get_vocab_size() <= 1 << 16
        for batch in batches:
            ids = enc.ids(batch.column("text").cast(pa.binary()).to_pylist(), end)
            key = batch.column("doc_id")
            part = np.searchsorted(bounds, key.fill_null(NULL_ID).to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays([
                pa.array(part.astype(np.int32)), key, pa.array([len(x) for x in ids], pa.int64()),
                pa.array([x.astype("<u2" if small else "<u4").tobytes() for x in ids], pa.binary())],
                names=["part", "doc_id", "n_tokens", "ids"])

    tokens = written(source.mapInArrow(tokenise, "part int, doc_id long, n_tokens long, ids binary"), "tokens")

    def unpack(raw: bytes, n: int) -> np.ndarray:
        return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            rows = zip(batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist())
            ids = [unpack(raw, n) for raw, n in rows]
            found = np.bincount(np.concatenate(ids)) if ids else total[:0]
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[:len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    # One row per id of the vocabulary and one per file: what the driver sees is bounded.
    found = (tokens.select("ids", "n_tokens").mapInArrow(count, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for row in found:
        counts[row["id"]] = row["n"]
    code = Code(code_lengths(counts, limit))
    totals = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    offsets, before = {}, 0
    for part in sorted(totals):
        offsets[part] = before
        before += totals[part]
    lengths = code.lengths

    def encode(batches):
        code, keys, held, size, part, before = Code(lengths), [], [], 0, None, 0
        for batch in batches:
            for p, key, n, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "ids"))):
                if held and (p != part or size >= BLOCK_IDS):
                    yield _binary(write_block(code, keys, held, before))
                    before, keys, held, size = before + size, [], [], 0
                if p != part:
                    part, before = p, offsets[p]
                keys.append(key)
                held.append(unpack(raw, n))
                size += n
        if held:
            yield _binary(write_block(code, keys, held, before))

    blocks = (tokens.repartitionByRange(parts, "part").sortWithinPartitions("part", "doc_id", "ids")
              .mapInArrow(encode, "block binary"))
    spark = source.sparkSession
    (blocks.select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/blocks"))
    (spark.createDataFrame([(bytearray(lengths.tobytes()),)], "value binary")
     .select(F.col("value").cast("string")).coalesce(1).write.text(f"{path}/codes"))


def _binary(raw: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["block"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, its ids."""
    lengths = b"".join(bytes(r["content"])[:-1] for r in spark.read.format("binaryFile")
                       .load(f"{path}/codes").select("content").collect())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches):
        code = Code(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for content in batch.column("content"):
                for keys, sizes, before, ids in read_blocks(code, content.as_buffer().to_pybytes()):
                    ends = np.cumsum(sizes)
                    raw = ids.astype("<u4").tobytes()
                    crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                    columns = [pa.array(keys, mask=keys == NULL_ID), pa.array(before + ends - sizes),
                               pa.array(sizes), pa.array(crcs, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    files = spark.read.format("binaryFile").load(f"{path}/blocks").select("content")
    return files.mapInArrow(decode, schema)
