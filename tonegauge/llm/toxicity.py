"""Severity of toxic language: cumulative-link ordinal regression on sparse text features.

P(grade <= k | x) = sigmoid(cut_k - w x): one weight vector for all thresholds, which are
kept in order. The label table says toxic or not; among toxic training texts the number of
features that mark toxicity cuts three grades of severity, so grades are 0 to 3.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import byte_words

#: Labelled rows the model is fitted on, of each label at most; the smallest hashes of doc_id.
SAMPLE = 5_000
GRADES = 3
STEMS = (4, 5, 6, 8)
SHARES = (0.05, 0.1, 0.2, 0.4)
LEAST_TEXTS, LEAST_Z = 3, 5.0
ROUNDS, RATE, RIDGE = 400, 0.1, 1e-5
STRIP = b".,;:!?\"'()[]"


def word_features(word: bytes) -> list[int]:
    """Hashes of a lower-cased word without its punctuation and of its beginnings."""
    core = word.strip(STRIP)
    return [xxhash.xxh3_64_intdigest(core) >> 1,
            *(xxhash.xxh3_64_intdigest(core[:n] + b"*") >> 1 for n in STEMS if len(core) > n)]


def manner_features(text: str | None) -> list[int]:
    """Hashes that say how much of a text is shouted: words in capitals, words with several marks."""
    words = (text or "").split()
    if not words:
        return []
    loud = sum(len(w) > 1 and w.isupper() for w in words) / len(words)
    marked = sum(w.endswith(("!!", "?!", "!?")) for w in words) / len(words)
    return [xxhash.xxh3_64_intdigest(f" {name} {step}".encode()) >> 1
            for name, share in (("capitals", loud), ("marks", marked)) for step in SHARES if share >= step]


@dataclass(frozen=True)
class SeverityModel:
    """Weights by feature, thresholds in order."""

    weights: dict[int, float]
    cuts: tuple[float, ...]


def chosen_features(texts: list[np.ndarray], toxic: np.ndarray) -> dict[int, int]:
    """Features whose share among toxic and other texts differs beyond chance, numbered."""
    every, counts = np.unique(np.concatenate(texts or [np.zeros(0, np.int64)]), return_counts=True)
    bad = [t for t, y in zip(texts, toxic) if y] or [np.zeros(0, np.int64)]
    some, hits = np.unique(np.concatenate(bad), return_counts=True)
    with_bad = np.zeros(len(every))
    with_bad[np.searchsorted(every, some)] = hits
    share = toxic.mean() if len(toxic) else 0.0
    spread = np.sqrt(np.maximum(counts * share * (1 - share), 1e-9))
    z = np.abs(with_bad - counts * share) / spread
    keep = every[(counts >= LEAST_TEXTS) & (z >= LEAST_Z)]
    return {int(f): i for i, f in enumerate(keep)}


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, width: int, top: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps with momentum (Adam) on the mean log-loss.

    Rows are index arrays of present features. Thresholds are the first one plus positive gaps.
    """
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    w, free = np.zeros(width), np.zeros(top)
    state = [np.zeros(width + top), np.zeros(width + top)]
    for step in range(1, ROUNDS + 1):
        cuts = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        score = np.bincount(owner, w[flat], len(rows))
        upper = np.concatenate([cuts, [np.inf]])[grades] - score
        lower = np.concatenate([[-np.inf], cuts])[grades] - score
        high, low = 1 / (1 + np.exp(-np.clip(upper, -500, 500))), 1 / (1 + np.exp(-np.clip(lower, -500, 500)))
        high, low = np.where(np.isinf(upper), 1.0, high), np.where(np.isinf(lower), 0.0, low)
        mass = np.maximum(high - low, 1e-12)
        by_high, by_low = high * (1 - high) / mass, low * (1 - low) / mass
        pull = (by_high - by_low) / len(rows)
        grad_w = np.bincount(flat, pull[owner], width) + RIDGE * w
        grad_cut = np.array([by_low[grades == k + 1].sum() - by_high[grades == k].sum() for k in range(top)]) / len(rows)
        chain = np.cumsum(grad_cut[::-1])[::-1]
        grad = np.concatenate([grad_w, chain[:1], chain[1:] * np.exp(free[1:])])
        for at, (keep, part) in enumerate(((0.9, grad), (0.999, grad * grad))):
            state[at] = keep * state[at] + (1 - keep) * part
        move = RATE * state[0] / (1 - 0.9 ** step) / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
        w, free = w - move[:width], free - move[width:]
    return w, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def grade_texts(texts: list[np.ndarray], toxic: np.ndarray, names: dict[int, int]) -> np.ndarray:
    """0 for texts that aren't toxic; 1 to GRADES by the number of toxic marks in toxic ones.

    Marks are chosen features that stand in toxic texts at least nine times in ten.
    """
    seen, bad = np.zeros(len(names)), np.zeros(len(names))
    index = [np.array([names[f] for f in t.tolist() if f in names], np.int64) for t in texts]
    for at, y in zip(index, toxic):
        seen[at] += 1
        bad[at] += y
    marks = bad >= 0.9 * np.maximum(seen, 1)
    n = np.array([marks[at].sum() for at in index])
    grades = np.zeros(len(texts), np.int64)
    if toxic.any():
        edges = np.quantile(n[toxic > 0], [i / GRADES for i in range(1, GRADES)])
        grades[toxic > 0] = 1 + np.searchsorted(edges, n[toxic > 0], "right")
    return grades


def training_rows(labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """At most ``sample`` labelled ids of either label; ids with several labels take the largest. Null
    ids and labels are passed over."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
             .groupBy(F.col(doc_id).cast("long").alias("train_id")).agg(F.max((F.col(toxic) > 0).cast("int")).alias("toxic")))
    order = [F.xxhash64("train_id"), F.col("train_id")]
    return known.where("toxic = 1").orderBy(*order).limit(sample).union(
        known.where("toxic = 0").orderBy(*order).limit(sample))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> SeverityModel:
    """Fits on the bounded labelled sample, in one task; the sample's ids are broadcast.

    Without a toxic text in the sample no feature is chosen and nothing is toxic.
    """
    ids = training_rows(labels, sample)
    rows = docs.select(F.col(doc_id).cast("long").alias("train_id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(ids), "train_id")

    def vectors(batches):
        for batch in batches:
            found = []
            for body in batch.column("text").to_pylist():
                hashes = [h for w in byte_words(body, lower=True) for h in word_features(w)]
                hashes += manner_features(body)
                found.append(np.unique(np.array(hashes, np.int64)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.binary())], names=["toxic", "f"])

    def learn(group):
        group = group.sort_by([("f", "ascending"), ("toxic", "ascending")])  # the same sums wherever rows come from
        toxic = group.column("toxic").to_numpy()
        texts = [np.frombuffer(b, np.int64) for b in group.column("f").to_pylist()]
        names = chosen_features(texts, toxic)
        grades = grade_texts(texts, toxic, names)
        index = [np.array([names[f] for f in t.tolist() if f in names], np.int64) for t in texts]
        w, cuts = fit_ordinal(index, grades, len(names))
        return pa.table({"key": pa.array([*names, *[-1] * GRADES], pa.int64()), "value": pa.array([*w, *cuts])})

    learned = (rows.select("toxic", "text").mapInArrow(vectors, "toxic int, f binary")
               .groupBy(F.lit(0).alias("all")).applyInArrow(learn, "key long, value double").collect())
    cuts = tuple(sorted(r["value"] for r in learned if r["key"] < 0)) or (50.0, 51.0, 52.0)
    return SeverityModel({r["key"]: r["value"] for r in learned if r["key"] >= 0}, cuts)


def score(docs: DataFrame, model: SeverityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, severity (the expected grade), grade (the likeliest), p_toxic, toxic.

    Whole texts; a null or empty text has no features and gets the model's answer to that.
    """
    cuts, weights = np.array(model.cuts), model.weights

    def run(batches):
        known: dict[bytes, tuple] = {}
        for batch in batches:
            scores = []
            for body in batch.column("text").to_pylist():
                present = {h for h in manner_features(body) if h in weights}
                for word in set(byte_words(body, lower=True)):
                    got = known.get(word)
                    if got is None:
                        if len(known) > 500_000:
                            known.clear()
                        got = known[word] = tuple(h for h in word_features(word) if h in weights)
                    present.update(got)
                scores.append(sum(weights[h] for h in sorted(present)))
            above = 1 / (1 + np.exp(np.clip(cuts[None] - np.array(scores).reshape(-1, 1), -500, 500)))
            edges = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(1)), pa.array((edges[:, :-1] - edges[:, 1:]).argmax(1)),
                 pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                names=["doc_id", "severity", "grade", "p_toxic", "toxic"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade long, p_toxic double, toxic boolean")
