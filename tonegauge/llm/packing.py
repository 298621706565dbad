"""Packing token pieces into sequences: first-fit decreasing with a tournament tree."""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import written
from tonegauge.llm.tokens import default_tokenizer, encoder

LENGTH = 2048
#: Pieces in a group on average; bounds a task's memory, not the data.
GROUP_PIECES = 50_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


class Tournament:
    """A complete tree over bins; every inner node knows the largest room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Puts a piece into the first bin with room and returns its number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
        return found


def first_fit_decreasing(sizes: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; larger pieces first, equal ones in their order."""
    tree = Tournament(len(sizes), room)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: dict[int, int] = {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = tree.first_fit(size)
        bins[i], offsets[i] = at, filled.get(at, 0)
        filled[at] = offsets[i] + size
    return bins, offsets


def cut(docs: DataFrame, tokenizer: str, end: int = 1, length: int = LENGTH, doc_id: str = "doc_id",
        text: str = "text") -> DataFrame:
    """Tokenises whole texts and cuts each document every ``length`` ids; ids themselves stay behind.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens. A null or empty text
    is a document of its end id alone.
    """
    def run(batches):
        enc, step = encoder(tokenizer), 4 * length
        for batch in batches:
            rows, out = [], []
            for row, ids in enumerate(enc.ids(batch.column("text").cast(pa.binary()).to_pylist(), end)):
                raw = ids.tobytes()
                for at in range(0, len(raw), step):
                    part = raw[at:at + step]
                    rows.append(row)
                    out.append((at // 4, len(part) // 4, zlib.crc32(part), len(raw) // 4))
            figures = np.array(out, np.int64).reshape(len(out), 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                + [pa.array(figures[:, i]) for i in range(4)], names=NAMES)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)


def pack(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES,
         seed: int = 0) -> DataFrame:
    """Adds sequence_id and offset to every piece of at most ``length`` ids.

    Pieces are dealt by a seeded hash into groups of about ``group_pieces``; each group is
    packed on its own. Sequences are numbered group * 2**32 + bin. Repeated rows are
    pieces of their own.
    """
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    key = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32"), F.lit(groups))
    schema = PIECES + ", sequence_id long, offset long"

    def run(key, group):
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                               ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), length)
        return pa.Table.from_arrays(
            [group.column(name) for name in NAMES]
            + [pa.array((key[0].as_py() << 32) + bins), pa.array(offsets)],
            names=[*NAMES, "sequence_id", "offset"])

    return pieces.withColumn("piece_group", key).groupBy("piece_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end: int = 1, length: int = LENGTH,
                   group_pieces: int = GROUP_PIECES, seed: int = 0, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Documents as pieces in sequences of at most ``length`` ids.

    Empty input gives no rows. Rows are documents, also where they repeat. Other columns
    are ignored.
    """
    tokenizer = tokenizer or default_tokenizer()
    pieces = written(cut(docs, tokenizer, end, length, doc_id, text), "pieces")
    return pack(pieces, length, group_pieces, seed)
