"""Term counts, distinctive terms, keyword effects and relational TF-IDF."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tonegauge.constants import TERM_STOPWORDS, TOXIC_THRESHOLD, TOXICITY_KEYWORDS
from tonegauge.functions import text


def term_counts(
    df: DataFrame, group: str, name: str = "text", stopwords: list[str] = TERM_STOPWORDS
) -> DataFrame:
    """Term frequency per group; partial counts leave each task, not tokens."""
    return (
        df.where(F.col(group).isNotNull())
        .select(group, F.explode(text.terms(F.col(name), stopwords)).alias("term"))
        .groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary(counts: DataFrame) -> DataFrame:
    """Union of the groups' vocabularies."""
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def distinctive_terms(
    df: DataFrame, group: str, groups: list[str], score: str = "score",
    name: str = "text", threshold: float = TOXIC_THRESHOLD, top: int = 15, min_count: int = 5,
) -> DataFrame:
    """Log-odds ratio with the pooled toxic counts as Dirichlet prior.

    One row per term holds the count of every group; the group totals are one
    more row.  So terms are shuffled once and no group's vocabulary meets in a
    task.  z is rounded before it is filtered and ranked.
    """
    toxic = df.where(F.col(score) > threshold).where(F.col(group).isin(groups))
    counts = [f"y_{i}" for i in range(len(groups))]
    table = (
        toxic.select(group, F.explode(text.terms(F.col(name))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("_prior"), *[
            F.count(F.when(F.col(group) == g, 1)).alias(c) for c, g in zip(counts, groups)])
    )
    totals = table.agg(
        F.sum("_prior").alias("_all"), *[F.sum(c).alias(f"_size_{c}") for c in counts])
    rows = F.array(*[
        F.struct(F.lit(g).alias(group), F.col(c).alias("_y"), F.col(f"_size_{c}").alias("_size"))
        for g, c in zip(groups, counts)
    ])
    prior, everything = F.col("_prior").cast("double"), F.col("_all").cast("double")
    y, size = F.col("_y").cast("double"), F.col("_size").cast("double")
    here, rest = y + prior, (prior - y) + prior
    here_other = size + everything - here
    rest_other = (everything - size) + everything - rest
    delta = F.log(here / here_other) - F.log(rest / rest_other)
    scored = (
        table.crossJoin(F.broadcast(totals))  # one row
        .select("term", "_prior", "_all", F.inline(rows))
        .where((F.col("_y") >= min_count) & (here_other > 0) & (rest_other > 0))
        .select(group, "term", F.round(delta / F.sqrt(1 / here + 1 / rest), 3).alias("z"),
                F.col("_y").alias("n"))
        .where(F.col("z") > 0)
    )
    best = Window.partitionBy(group).orderBy(F.col("z").desc(), F.col("n").desc(), "term")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def toxic_notice(df: DataFrame, score: str = "score", threshold: float = TOXIC_THRESHOLD) -> DataFrame:
    """The notice row that stands in when no row is over the threshold."""
    return df.agg(F.count(F.when(F.col(score) > threshold, 1)).alias("n_toxicos")).withColumn(
        "aviso", F.when(F.col("n_toxicos") == 0, "no comment exceeds the threshold"))


def keyword_effect(
    df: DataFrame, name: str = "text_content", score: str = "toxicity_score",
    keywords: list[str] = TOXICITY_KEYWORDS, min_posts: int = 30, digits: int = 3,
) -> DataFrame:
    """Mean score with and without each keyword.

    A post yields one row per keyword it holds, not one per keyword tried, and
    the posts without it follow from the totals, one row.
    """
    lowered = F.lower(text.or_empty(F.col(name)))
    held = F.filter(
        F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("_text"), F.lower(k)))
    value = F.col("_score")
    base = df.select(lowered.alias("_text"), F.col(score).cast("double").alias("_score"))
    matched = (
        base.select("_score", F.explode(held).alias("palabra")).groupBy("palabra")
        .agg(F.count(F.lit(1)).alias("n_posts"), F.sum(value).alias("_sum"),
             F.count(value).alias("_known"))
    )
    totals = base.agg(F.sum(value).alias("_all_sum"), F.count(value).alias("_all_known"))
    with_mean = F.round(F.try_divide(F.col("_sum"), F.col("_known")), digits)
    without = F.round(F.try_divide(
        F.col("_all_sum") - F.coalesce("_sum", F.lit(0.0)),
        F.col("_all_known") - F.col("_known")), digits)
    return (
        matched.where(F.col("n_posts") > min_posts).crossJoin(F.broadcast(totals))  # one row
        .select("palabra", "n_posts", with_mean.alias("tox_medio_con"),
                without.alias("tox_medio_sin"))
        .withColumn("diferencia", F.round(F.col("tox_medio_con") - F.col("tox_medio_sin"), digits))
    )


#: Tokens that a worker counts together; bounds its memory however many texts a batch has.
COUNT_TOKENS = 1 << 20
#: Counters for pairs of words, by hash: a bound for every pair before any of them is named.
PAIR_COUNTERS = 1 << 18  # a power of two
#: Factors of the bytes of a word in its hash.
_FACTORS = np.random.default_rng(0).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _words(df: DataFrame, keep: list[str], name: str, stopwords: list[str] | None) -> DataFrame:
    """Words are found once per text, also where pairs are built from them."""
    words = text.tokens(F.col(name))
    if stopwords:
        words = F.filter(words, lambda w: ~w.isin(stopwords))
    return df.select(*keep, words.alias("_words"))


def _with_grams(df: DataFrame, keep: list[str], name: str, grams: int, stopwords: list[str] | None) -> DataFrame:
    found = text.with_pairs(F.col("_words")) if grams == 2 else F.col("_words")
    return _words(df, keep, name, stopwords).select(*keep, found.alias("_grams"))


def _tally(group: np.ndarray, doc: np.ndarray, code: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """Occurrences and documents of each name, given by codes, in each group of documents."""
    n, size = len(names), len(names) * (int(group.max()) + 1)
    each = np.sort(doc * n + code)  # far quicker than numpy's own distinct values
    held, own = np.divmod(each[np.flatnonzero(np.diff(each, prepend=-1))], n)  # each distinct name of a document
    total = np.bincount(group[doc] * n + code, minlength=size)
    found = np.flatnonzero(total)
    df = np.bincount(group[held] * n + own, minlength=size)[found]
    return pa.RecordBatch.from_pydict({
        "_group": pa.array(found // n, pa.int32()), "term": names.take(pa.array(found % n)),
        "total": pa.array(total[found], pa.int64()), "df": pa.array(df, pa.int64())})


def _coded(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and code of every word, and the names that the codes count through."""
    coded = words.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
    return doc, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _counters(names: pa.Array, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The counter of each pair of names; the same for equal pairs in every task."""
    raw = names.cast(pa.binary())
    cuts = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, 4 * raw.offset).astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8, cuts[-1] - cuts[0], cuts[0]).astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(cuts[:-1] - cuts[0], np.diff(cuts))
    upto = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * _FACTORS[place % len(_FACTORS)]))
    own = upto[cuts[1:] - cuts[0]] - upto[cuts[:-1] - cuts[0]]
    mixed = (own[first] * np.uint64(0x9E3779B97F4A7C15) + own[second]) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) & np.uint64(PAIR_COUNTERS - 1)).astype(np.int64)


def _bounded_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts' words to their counts (counter -1), and at the end of a task to the counters of its pairs."""
    counters = np.zeros(PAIR_COUNTERS, np.int64)
    for batch in batches:
        for low, high in _bounded(batch.column("_words")):
            doc, code, names = _coded(batch.column("_words").slice(low, high - low))
            if not len(code):
                continue
            found = _tally(np.zeros(high - low, np.int64), doc, code, names)
            yield pa.RecordBatch.from_arrays(
                [found.column("term"), pa.array(np.full(found.num_rows, -1, np.int32)), *found.columns[2:]],
                names=["term", "counter", "total", "df"])
            at = np.flatnonzero(doc[1:] == doc[:-1])
            counters += np.bincount(_counters(names, code[at], code[at + 1]), minlength=PAIR_COUNTERS)
    used = np.flatnonzero(counters)
    yield pa.RecordBatch.from_pydict({
        "term": pa.array([""] * len(used), pa.string()), "counter": pa.array(used, pa.int32()),
        "total": pa.array(counters[used]), "df": pa.array(np.zeros(len(used), np.int64))})


def _counted_pairs(open_counters: bytes):
    """Texts' words to the counts of those pairs whose counter is open (a bit for each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_open = np.unpackbits(np.frombuffer(open_counters, np.uint8)).astype(bool)
        for batch in batches:
            for low, high in _bounded(batch.column("_words")):
                doc, code, names = _coded(batch.column("_words").slice(low, high - low))
                at = np.flatnonzero(doc[1:] == doc[:-1])
                at = at[is_open[_counters(names, code[at], code[at + 1])]]
                if len(at):
                    both, own = np.unique(code[at] * len(names) + code[at + 1], return_inverse=True)
                    first, second = (names.take(pa.array(c)) for c in np.divmod(both, len(names)))
                    yield _tally(np.zeros(high - low, np.int64), doc[at], own,
                                 pc.binary_join_element_wise(first, second, " "))

    return run


def _frequent_terms(words: DataFrame, most: int, min_df: int) -> DataFrame:
    """(term, total, df) of the ``most`` frequent words and pairs, and of some that are less frequent.

    A pair beside the most frequent words must occur as often as the last of these. The
    first pass counts the words, and the pairs into ``PAIR_COUNTERS`` counters by hash,
    which no pair exceeds; the second names and counts only pairs whose counter reaches that far.
    """
    counts = words.mapInArrow(_bounded_pairs, "term string, counter int, total bigint, df bigint").groupBy(
        "term", "counter").agg(F.sum("total").alias("total"), F.sum("df").alias("df")).persist()
    single = counts.where((F.col("counter") < 0) & (F.col("df") >= min_df)).select("term", "total", "df")
    top = single.orderBy(F.col("total").desc(), "term").limit(most).toArrow()  # at most ``most`` rows
    least = max(top.column("total")[-1].as_py() if most and top.num_rows == most else 0, min_df, 1)
    reached = counts.where((F.col("counter") >= 0) & (F.col("total") >= least)).select("counter").toArrow()
    counts.unpersist()
    bits = np.zeros(PAIR_COUNTERS, bool)
    bits[reached.column("counter").to_numpy()] = True
    schema = "_group int, term string, total bigint, df bigint"
    pairs = words.mapInArrow(_counted_pairs(np.packbits(bits).tobytes()), schema).groupBy("term").agg(
        F.sum("total").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_df)
    return words.sparkSession.createDataFrame(top).select(single.columns).union(pairs)


def _counted(pairs: bool):
    """Texts' words to the counts of terms, equal terms of many texts added up."""
    def each(group: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        doc, code, names = _coded(words)
        if not len(code):
            return
        yield _tally(group, doc, code, names)
        at = np.flatnonzero(doc[1:] == doc[:-1]) if pairs else []
        if len(at):
            both, code = np.unique(code[at] * len(names) + code[at + 1], return_inverse=True)
            first, second = (names.take(pa.array(c)) for c in np.divmod(both, len(names)))
            yield _tally(group, doc[at], code, pc.binary_join_element_wise(first, second, " "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, words = batch.column("_group").to_numpy().astype(np.int64), batch.column("_words")
            for low, high in _bounded(words):
                yield from each(group[low:high], words.slice(low, high - low))

    return run


def _bounded(words: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``COUNT_TOKENS`` words, or one text with more."""
    upto = np.cumsum(words.value_lengths().to_numpy())
    low = 0
    while low < len(words):
        least = (upto[low - 1] if low else 0) + COUNT_TOKENS
        high = max(int(np.searchsorted(upto, least, "right")), low + 1)
        yield low, high
        low = high


def _weighted(terms: list[str], idf: list[float], key: str):
    """Texts' words to a row for each term of the vocabulary in a text, with count and normalised weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, scale = pa.array(terms, pa.string()), np.array(idf)
        # A pair is named by the places of its words among all words of the vocabulary.
        parts = [t.split(" ") for t in terms]
        places = {w: i for i, w in enumerate(dict.fromkeys(w for p in parts for w in p))}
        known, n = pa.array(list(places), pa.string()), len(places) + 1
        single = np.full(n, -1)
        for i, p in enumerate(parts):
            if len(p) == 1:
                single[places[p[0]]] = i
        codes = sorted((places[p[0]] * n + places[p[1]], i) for i, p in enumerate(parts) if len(p) == 2)
        pair, pair_term = np.array([c for c, _ in codes], np.int64), np.array([i for _, i in codes], np.int64)
        for batch in batches:
            for low, high in _bounded(batch.column("_words")):
                words = batch.column("_words").slice(low, high - low)
                place = pc.fill_null(pc.index_in(words.flatten(), known), n - 1).to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
                term = single[place]
                held = [doc[term >= 0] * len(terms) + term[term >= 0]]
                if len(pair):
                    at = np.flatnonzero((doc[1:] == doc[:-1]) & (place[1:] < n - 1) & (place[:-1] < n - 1))
                    code = place[at] * n + place[at + 1]
                    spot = np.minimum(np.searchsorted(pair, code), len(pair) - 1)
                    hit = pair[spot] == code
                    held.append(doc[at[hit]] * len(terms) + pair_term[spot[hit]])
                both, tf = np.unique(np.concatenate(held), return_counts=True)
                own, term = np.divmod(both, max(len(terms), 1))
                weight = tf * scale[term]
                norm = np.sqrt(np.bincount(own, weight * weight, len(words)))
                yield pa.RecordBatch.from_pydict({
                    key: batch.column(key).slice(low, high - low).take(pa.array(own)), "term": names.take(pa.array(term)),
                    "tf": pa.array(tf, pa.int64()), "weight": pa.array(weight / norm[own])})

    return run


def _term_counts(words: DataFrame, pairs: bool) -> DataFrame:
    """(_group, term, total, df) from rows (_group, _words)."""
    rows = words.mapInArrow(_counted(pairs), "_group int, term string, total bigint, df bigint")
    return rows.groupBy("_group", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def fold_vocabularies(
    df: DataFrame, name: str, folds: list[int], grams: list[int], max_features: int, min_df: int = 1,
    fold: str = "fold",
) -> DataFrame:
    """(part, grams, term, df, rank): the vocabulary of all rows but each fold's, for each gram setting.

    The texts are counted once, by fold; what the parts add up is counts.
    """
    words = _words(df.withColumn("_group", F.col(fold).cast("int")), ["_group"], name, None)
    counts = _term_counts(words, max(grams) == 2).withColumnRenamed("_group", fold)
    parts = counts.withColumn("part", F.explode(F.array(*map(F.lit, folds)))).where(F.col(fold) != F.col("part"))
    terms = parts.groupBy("part", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    named = terms.where(F.col("df") >= min_df).withColumn("grams", F.explode(F.array(*map(F.lit, grams)))).where(
        (F.col("grams") > 1) | ~F.col("term").contains(" "))
    order = Window.partitionBy("part", "grams").orderBy(F.col("total").desc(), "term")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_features).select(
        "part", "grams", "term", "df", "rank")


def corpus_vocabulary(
    df: DataFrame, name: str, grams: int = 1, max_features: int | None = 5000,
    min_df: int = 1, stopwords: list[str] | None = None,
) -> DataFrame:
    """Terms with total count and number of documents, the most frequent first.

    Workers count the words of many texts at once and send each distinct term with both
    counts, so only the vocabulary is shuffled, not the texts. Of a limited vocabulary, words
    are counted at once and pairs that can't be in it stay behind (``_frequent_terms``).
    """
    if grams == 2 and max_features:
        terms = _frequent_terms(_words(df, [], name, stopwords), max_features, min_df)
        return terms.orderBy(F.col("total").desc(), "term").limit(max_features)
    words = _words(df.withColumn("_group", F.lit(0)), ["_group"], name, stopwords)
    terms = _term_counts(words, grams == 2).where(F.col("df") >= min_df).drop("_group")
    return terms.orderBy(F.col("total").desc(), "term").limit(max_features) if max_features else terms


def tfidf(
    df: DataFrame, key: str, name: str, grams: int = 1, max_features: int | None = 5000,
    min_df: int = 1, stopwords: list[str] | None = None,
) -> DataFrame:
    """M1, relational: smoothed idf plus one, L2 norm 1 per document.

    The vocabulary keeps the most frequent terms (ties by name).  It has at most
    ``max_features`` rows, which go to the workers; they count and weigh the terms of a text
    in its own row, so neither texts nor counts are shuffled.  An unlimited vocabulary
    is joined by shuffle.
    """
    vocabulary = corpus_vocabulary(df, name, grams, max_features, min_df, stopwords)
    size = df.agg(F.count(F.lit(1)).alias("_docs"))
    idf = vocabulary.crossJoin(F.broadcast(size)).select(  # one row
        "term", (F.log((1 + F.col("_docs")) / (1 + F.col("df"))) + 1).alias("_idf"))
    if max_features:
        found = idf.collect()  # at most max_features rows
        words = _words(df, [key], name, stopwords)
        schema = StructType([words.schema[key], StructField("term", StringType()), StructField("tf", LongType()),
                             StructField("weight", DoubleType())])
        return words.mapInArrow(_weighted([r["term"] for r in found], [r["_idf"] for r in found], key), schema)
    tokens = _with_grams(df, [key], name, grams, stopwords).select(key, F.explode("_grams").alias("term"))
    tf = tokens.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")).join(idf, "term")
    weight = F.col("tf") * F.col("_idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy(key)))  # the terms of one text
    return tf.select(key, "term", "tf", (weight / norm).alias("weight"))


def top_terms(weights: DataFrame, group: str, by: str = "weight", top: int = 8) -> DataFrame:
    """The best terms of each group."""
    best = Window.partitionBy(group).orderBy(F.col(by).desc(), "term")
    return weights.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def cluster_terms(weights: DataFrame, members: DataFrame, key: str, cluster: str, top: int = 8) -> DataFrame:
    """Highest mean TF-IDF weight per cluster; absent terms count as 0."""
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("_size"))
    means = (
        weights.join(members.select(key, cluster), key)
        .groupBy(cluster, "term").agg(F.sum("weight").alias("_sum"))
        .join(sizes, cluster)
        .select(cluster, "term", F.round(F.col("_sum") / F.col("_size"), 6).alias("weight"))
    )
    return top_terms(means, cluster, "weight", top)
