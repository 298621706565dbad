"""Benchmark decontamination with DataFrame functions only.

Normalised windows of the test items form a broadcast hash set. Every window of every
training text is hashed and looked up; a hit is verified word by word before it counts.
The lookup, the verification and the window expressions run in one generated stage, so
only hits (and one row per document) are shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.common import ascii_lower

#: Everything that is no word character: ASCII other than digits and a-z.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: An item's words beyond which its windows are joined by a shuffle instead of a broadcast.
BROADCAST_WORDS = 500_000


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for a null or empty one."""
    parts = F.split(F.coalesce(ascii_lower(text), F.lit("")), BREAK, -1)
    return F.filter(parts, lambda w: w != "")


def item_windows(benchmark: DataFrame, n: int = 10, item_id: str = "item_id",
                 text: str = "text") -> DataFrame:
    """One row per distinct window: ``gram``, its ``gram_hash`` and the ``items`` that have it.

    Items without words have no window; an item of fewer than ``n`` words is one window.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w"))
    gram = F.when(F.size("w") < n, F.array("w")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n)))
    grams = items.where(F.size("w") > 0).select("item", F.explode(gram).alias("gram"))
    return (grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64("gram").alias("gram_hash"), "gram", "items"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, spans, n_hit, items.

    ``spans`` are [start, end) word offsets of verified windows, sorted; ``n_hit`` counts
    the words in their union; ``items`` are the distinct item ids as strings, sorted.
    A null or empty text has no words and no hits. Rows with equal id and text get equal
    results, as many as there were. Other columns of either input are ignored.
    Item windows are broadcast if the items have at most ``broadcast_words`` words in all;
    beyond that the same join shuffles.
    """
    grams = item_windows(benchmark, n, item_id, item_text)
    size = benchmark.agg(
        F.sum(F.size(words(F.col(item_text)))).alias("words"),
        F.collect_set(F.least(F.size(words(F.col(item_text))), F.lit(n))).alias("lengths")).first()
    lengths = sorted(set(size["lengths"]) - {0}) or [n]
    if (size["words"] or 0) <= broadcast_words:
        grams = F.broadcast(grams)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                         words(F.col(text)).alias("w"))
    # Step -1 stands for the document itself, step i for a window start and one of the lengths.
    steps = source.select("*", F.explode(F.sequence(
        F.lit(-1), F.size("w") * len(lengths) - 1)).alias("step"))
    length = F.element_at(F.array(*map(F.lit, lengths)), F.expr(f"pmod(step, {len(lengths)})") + 1)
    start = F.expr(f"step div {len(lengths)}").cast("int")
    fits = (F.col("step") >= 0) & (start + length <= F.size("w"))
    probes = steps.withColumn("found", F.when(fits, F.slice("w", start + 1, length)))
    probes = probes.select("doc_id", "text_hash", "step", F.size("w").alias("n_words"), "found",
                           start.alias("start"), (start + length).alias("end"),
                           F.when(F.col("found").isNotNull(), F.xxhash64("found")).alias("found_hash"))
    # array_contains keeps the word comparison out of the join keys: the hash alone is the key.
    hits = probes.join(grams, (F.col("found_hash") == F.col("gram_hash"))
                       & F.array_contains(F.array("gram"), F.col("found")), "left")
    hits = hits.where((F.col("step") < 0) | F.col("gram").isNotNull())
    span = F.when(F.col("step") >= 0, F.struct("start", "end"))
    rows = hits.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(F.col("step") < 0, 1)).alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.collect_set("items").alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n")))
    rows = rows.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), "spans",
        covered["n"].cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return rows.drop("copy")


def _matches(docs: DataFrame, benchmark: DataFrame, n: int, doc_id: str, text: str, **kw):
    found = contamination(docs, benchmark, n, doc_id, text, **kw).where("n_hit > 0")
    found = found.groupBy(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_text")).agg(
        F.first("spans").alias("_spans"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_id"),
                       F.xxhash64(F.col(text)).alias("_text"))
    on = F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_text") == F.col("_hit_text"))
    return rows, found, on


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id",
                     text: str = "text", **kw) -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    rows, found, on = _matches(docs, benchmark, n, doc_id, text, **kw)
    return rows.join(found, on, "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id",
                 text: str = "text", **kw) -> DataFrame:
    """All documents; words inside benchmark windows are cut from the text, the rest stays as it is."""
    rows, found, on = _matches(docs, benchmark, n, doc_id, text, **kw)
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    # Word i stands after gap i; the pieces keep the original letters.
    gaps = F.split(body, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)
    runs = F.filter(F.split(body, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), lambda w: w != "")
    kept = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("upto"), F.array().cast("array<struct<a:int,b:int>>").alias("keep")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"]).alias("upto"),
            F.when(s["start"] > acc["upto"], F.array_append(
                acc["keep"], F.struct(acc["upto"].alias("a"), s["start"].alias("b"))))
            .otherwise(acc["keep"]).alias("keep")))
    keep = F.array_append(kept["keep"], F.struct(kept["upto"].alias("a"), F.size("_runs").alias("b")))
    pieces = F.flatten(F.transform(keep, lambda k: F.slice("_pairs", k["a"] + 1, k["b"] - k["a"])))
    cut = (rows.join(found, on, "left")
           .withColumn("_runs", F.when(F.col("_spans").isNotNull(), runs))
           .withColumn("_gaps", F.when(F.col("_spans").isNotNull(), gaps))
           .withColumn("_pairs", F.zip_with(F.slice("_gaps", 1, F.size("_runs")), "_runs",
                                            lambda g, w: F.concat(g, w)))
           .withColumn("_cut", F.concat(F.array_join(pieces, ""), F.element_at("_gaps", -1))))
    new = F.when(F.col("_spans").isNotNull(), F.col("_cut")).otherwise(F.col(f"row.`{text}`"))
    return cut.select([new.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
