"""Groups spelling variants: words one edit apart, found by signatures of their letters.

A word is the multiset of its letters, a binary vector with one dimension for each letter and each of
its occurrences. One edit moves at most two dimensions. PartEnum deals the dimensions into ``parts`` by
hash and makes a signature of what stands in every choice of all but two parts: vectors at a Hamming
distance of at most two agree on one of these at least, so an equi-join on signatures meets every pair,
and the edit distance decides. All of it is DataFrame functions.

Defined cases: a null text has no words, a null id counts as an empty string in the hash that damages
words, repeated rows count each time, an empty table gives no rows. Ties go to the smaller word in
code-point order, which is the byte order of UTF-8. Other columns are ignored; texts count whole.
"""

from itertools import combinations
from math import ceil, log, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import ascii_lower, by_shuffle, written

#: Basic Latin letters and U+00C0 to U+00FF.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
SHORTEST = 6
LEAST = 5
#: A word is a variant of a neighbour at least this many times as frequent.
RATIO = 5
#: A run's hash divisible by this loses a letter.
DAMAGE = 199
#: Most dimensions an edit moves: one for an added or missing letter, two for another letter.
MOVED = 2
PARTS = 8


def damaged_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(word): lower-case runs of letters, some of which lose a letter by the hash of id and run.

    Shorter runs are left in the text, as losing a letter makes none of them long enough.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", ascii_lower(F.col("run")).alias("w"))
    found = found.select("w", F.crc32(F.concat("id", F.lit(":"), "w").cast("binary")).alias("h"))
    at = F.expr("cast(h % length(w) as int)")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    return found.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("w")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): long enough words and how often they occur, if often enough."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def signed(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(signature, word, n, size): a row for each choice of all but MOVED parts."""
    sets = [sum(1 << p for p in chosen) for chosen in combinations(range(parts), parts - MOVED)]
    letters = words.select("word", F.sort_array(F.split("word", F.lit(""))).alias("c"))
    # Sorted, so a letter's place after the first of its kind is its occurrence.
    part = lambda c, i: F.pmod(F.xxhash64(c, i - F.array_position("c", c)), F.lit(parts)).cast("int")
    bit = F.transform("c", lambda c, i: F.named_struct(
        F.lit("c"), c, F.lit("bit"), F.call_function("shiftleft", F.lit(1), part(c, i))))
    dealt = letters.select("word", bit.alias("d"), F.explode(F.array(*map(F.lit, sets))).alias("set"))
    kept = F.array_join(F.transform(
        F.filter("d", lambda x: x["bit"].bitwiseAND(F.col("set")) != 0), lambda x: x["c"]), "")
    return dealt.select(F.xxhash64("set", kept).alias("signature"), "word")


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, n, other, other_n), each pair once: exactly one inserted, deleted or replaced code point."""
    # 28 rows a word, of which Spark's estimate knows nothing.
    rows = by_shuffle(signed(words, parts))
    x, y = rows.alias("x"), rows.alias("y")
    meets = ((F.col("x.word") < F.col("y.word"))
             & (F.abs(F.length("x.word") - F.length("y.word")) < MOVED)
             & (F.levenshtein("x.word", "y.word", 1) == 1))
    # A pair may share several signatures.
    pairs = x.join(y, F.col("x.signature") == F.col("y.signature")).where(meets).select(
        F.col("x.word").alias("word"), F.col("y.word").alias("other")).distinct()
    count = by_shuffle(words.select("word", "n"))
    return pairs.join(count, "word").join(count.toDF("other", "other_n"), "other")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): how many words are near, and the most frequent of them if it is
    ``ratio`` times as frequent."""
    both = pairs.select("word", "other", "other_n").union(
        pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    led = -F.col("best.less") >= ratio * F.col("n")
    return words.join(by_shuffle(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(led, F.col("best.form")).alias("form"), F.when(led, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """Adds the last word that forms lead to. Counts grow by ``ratio`` at each step, which bounds the
    steps by the logarithm of the largest count; every round doubles how far a word has followed."""
    most = found.agg(F.max("n")).first()[0] or least
    steps = log(max(most / least, 1), ratio) + 1
    root = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    for _ in range(ceil(log2(steps)) if steps > 1 else 0):
        further = root.select(F.col("word").alias("at"), F.col("root").alias("further"))
        root = written(root.join(by_shuffle(further), root.root == further.at, "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")
    return found.join(by_shuffle(root), "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of SHORTEST letters that occurs LEAST times."""
    words = written(vocabulary(damaged_words(docs, key, text)), "words")
    found = written(forms(words, written(near_pairs(words), "pairs")), "forms")
    return roots(found)
