"""Weak supervision of document quality: rules vote, expectation-maximisation weighs them."""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm.common import SPACE, byte_words

SYMBOLS = "#*$%&|<>"
FEATURES = T.StructType([T.StructField(name, T.LongType()) for name in (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct",
    "n_stops", "n_letters")])


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that occur twice or more, and the number of distinct words."""
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(ids) < 4:
        return 0, len(codes)
    # Pairs are ranked first, so that no key can overflow, however long the text.
    pairs = np.unique(ids[:-1] * len(codes) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(codes) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    hit = np.zeros(len(ids), bool)
    for shift in range(3):
        hit[shift:shift + len(again)] |= again
    return int(hit.sum()), len(codes)


def features(text: str | None) -> tuple:
    """The figures the rules look at, of the whole text; a null text has none of anything."""
    text = text or ""
    words = byte_words(text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated, distinct = repeat_words(words)
    chars = len(text) - sum(map(text.count, SPACE))
    odd = sum(map(text.count, "0123456789" + SYMBOLS + "@=_{}[]~^\\/+"))
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated, distinct, sum(map(text.count, ".!?")), chars - odd)


@F.pandas_udf(FEATURES)
def _features(texts: pd.Series) -> pd.DataFrame:
    rows = [features(t) for t in texts]
    return pd.DataFrame(rows, columns=FEATURES.names, dtype="int64")


def base_failed(x: Column) -> Column:
    return (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])


def rules(x: Column) -> dict[str, Column]:
    """The rules: 1 for good, -1 for bad, 0 where a rule abstains or has nothing to look at.

    A rule that looks for one fault speaks only when it finds it; a good vote needs
    several signs of plain prose at once.
    """
    words = F.when(x["n_words"] > 0, x["n_words"])
    chars = F.when(x["word_chars"] > 0, x["word_chars"])
    repeat, symbols = x["n_repeat_words"] / words, x["n_symbols"] / words
    copied = F.coalesce(x["n_dup_lines"] / F.when(x["n_lines"] > 1, x["n_lines"]), F.lit(0.0))
    length, stops, letters = chars / words, x["n_stops"] / words, x["n_letters"] / chars
    # Long texts repeat words by nature: the measure grows with the logarithm of the length.
    variety = x["n_distinct"] / words * F.log2(words + 2)
    tests = {
        "long_enough": (None, x["n_words"] < 50),
        "few_repeats": (None, repeat > 0.4),
        "few_symbols": (None, symbols > 0.2),
        "own_lines": (None, (copied > 0.3) & (x["n_lines"] >= 5)),
        "word_length": (None, (length < 2.5) | (length > 12)),
        "sentences": (None, (stops < 0.002) | (stops > 0.7)),
        "variety": (None, variety < 0.8),
        "letters": (None, letters < 0.8),
        "plain": ((symbols < 0.05) & (letters > 0.9) & (repeat < 0.2) & (copied <= 0.5), None),
        "prose": ((x["n_words"] >= 50) & length.between(3, 10) & stops.between(0.005, 0.5)
                  & (symbols < 0.1), None),
    }
    votes = {}
    for name, (good, bad) in tests.items():
        vote = F.when(bad, -1) if good is None else F.when(good, 1)
        votes[name] = F.coalesce(vote, F.lit(0))
    return votes


@dataclass(frozen=True)
class RuleModel:
    """The share of good documents and, by rule, what it says (-1, 0, 1) about good and bad ones."""

    prior: float
    says: dict[str, tuple[tuple[float, float, float], tuple[float, float, float]]]

    def accuracy(self, name: str) -> float:
        """How often the rule is right where it votes."""
        good, bad = self.says[name]
        right = self.prior * good[2] + (1 - self.prior) * bad[0]
        return right / (right + self.prior * good[0] + (1 - self.prior) * bad[2])


def fit_counts(names: list[str], votes: np.ndarray, counts: np.ndarray, rounds: int = 500,
               strength: float = 0.01) -> RuleModel:
    """Expectation-maximisation over counted vote patterns (one row per distinct pattern).

    Each rule starts as right 60, silent 30 and wrong 10 times in 100; this start is also
    the prior mean of its probabilities, with the weight of a ``strength`` share of the
    documents. The share of good documents stays between 0.05 and 0.95.
    """
    total, prior = counts.sum(), 0.8
    start = np.array([[0.1, 0.3, 0.6], [0.6, 0.3, 0.1]])
    says = np.repeat(start[None], len(names), axis=0)
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds if total else 0):
        fit = np.einsum("prv,rcv->pc", cast, np.log(says))
        good = counts / (1 + np.exp(fit[:, 1] - fit[:, 0] + math.log((1 - prior) / prior)))
        heard = np.einsum("pc,prv->rcv", np.stack([good, counts - good], axis=1), cast)
        new = heard + strength * total * start
        new /= new.sum(axis=2, keepdims=True)
        share = float(np.clip(good.sum() / total, 0.05, 0.95))
        moved = max(abs(share - prior), float(np.abs(new - says).max()))
        prior, says = share, new
        if moved < 1e-9:
            break
    return RuleModel(prior, {n: tuple(map(tuple, says[i].tolist())) for i, n in enumerate(names)})


def fit(docs: DataFrame, text: str = "text") -> RuleModel:
    """Learns from the vote patterns of all documents; at most 3 to the number of rules rows leave Spark."""
    x = docs.select(_features(F.col(text)).alias("x"))
    votes = rules(F.col("x"))
    names = list(votes)
    seen = x.select(*[v.alias(k) for k, v in votes.items()]).groupBy(names).count().collect()
    table = np.array([[row[n] for n in names] for row in seen], dtype=float).reshape(len(seen), len(names))
    order = np.lexsort(table.T) if len(seen) else []
    return fit_counts(names, table[order], np.array([row["count"] for row in seen], dtype=float)[order])


def posterior(x: Column, model: RuleModel) -> Column:
    """The probability that a document is good, given its votes."""
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for name, vote in rules(x).items():
        low, none, high = (math.log(g / b) for g, b in zip(*model.says[name]))
        odds = odds + F.when(vote > 0, high).when(vote < 0, low).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """All rows as ``row`` (a struct of their columns) with ``x`` (the figures), base_failed,
    quality (the posterior) and kept. Null and empty texts fail the base test."""
    rows = docs.select(F.struct("*").alias("row"), _features(F.col(text)).alias("x"))
    rows = rows.withColumns({"base_failed": base_failed(F.col("x")),
                             "quality": posterior(F.col("x"), model)})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose posterior reaches the threshold and that pass the base test."""
    return judge(docs, fit(docs, text), text, threshold).where("kept").select("row.*")
