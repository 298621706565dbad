"""Classification, agreement and clustering metrics as relations.

Everything starts from the count of each (truth, prediction) pair, so the row-scale
work is one partial aggregation; the rest runs on classes x classes rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonegauge.constants import PUBLISHED_TONE_F1, SIGNAL_MARGIN


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (truth, prediction)."""
    return (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).cast("string").alias("label"),
                 F.col(prediction).cast("string").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: list[str]) -> DataFrame:
    """One row per label in fixed order, absent labels as zero rows."""
    pairs = pair_counts(df, label, prediction).where(
        F.col("label").isin(labels) & F.col("prediction").isin(labels))
    counts = pairs.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col("prediction") == p, F.col("n"))), F.lit(0)).alias(f"pred_{p}")
        for p in labels])
    frame = df.sparkSession.createDataFrame(list(enumerate(labels)), "position int, label string")
    # One row per class on both sides.
    return frame.join(F.broadcast(counts), "label", "left").select(
        "position", "label",
        *[F.coalesce(f"pred_{p}", F.lit(0).cast("bigint")).alias(f"pred_{p}") for p in labels])


def confusion_share(matrix: DataFrame, labels: list[str], digits: int = 2) -> DataFrame:
    """Rows of the matrix in percent."""
    total = reduce(lambda a, b: a + b, [F.col(f"pred_{p}") for p in labels])
    return matrix.select("position", "label", *[
        F.round(F.try_divide(F.lit(100.0) * F.col(f"pred_{p}"), total.cast("double")), digits)
        .alias(f"pred_{p}") for p in labels])


def binary_cells(df: DataFrame, label: str, prediction: str, negative: str, positive: str) -> DataFrame:
    """TN, FP, FN and TP in one row."""
    def cell(truth: str, guess: str, out: str) -> Column:
        hit = (F.col("label") == truth) & (F.col("prediction") == guess)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(out)

    return pair_counts(df, label, prediction).agg(
        cell(negative, negative, "tn"), cell(negative, positive, "fp"),
        cell(positive, negative, "fn"), cell(positive, positive, "tp"))


def class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side."""
    pairs = pair_counts(df, label, prediction)
    # Each pair counts for its truth and for its prediction: one pass, no outer join.
    def side(name: str, actual: Column, predicted: Column, tp: Column) -> Column:
        return F.struct(F.col(name).alias("label"), actual.alias("actual"),
                        predicted.alias("predicted"), tp.alias("tp"))

    none, n = F.lit(0).cast("bigint"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    sides = pairs.select(F.inline(F.array(
        side("label", n, none, hit), side("prediction", none, n, none))))
    sums = sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"),
        F.sum("actual").alias("support"))
    zero = F.lit(0.0)
    tp = F.col("tp").cast("double")
    precision = F.coalesce(F.try_divide(tp, F.col("predicted").cast("double")), zero)
    recall = F.coalesce(F.try_divide(tp, F.col("support").cast("double")), zero)
    f1 = F.coalesce(F.try_divide(2 * tp, (F.col("predicted") + F.col("support")).cast("double")), zero)
    return sums.select(
        "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        "support", "tp")


def macro_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and unweighted means over the classes, one row."""
    return class_scores(df, label, prediction).agg(
        F.sum("support").alias("n"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def classification_report(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """Classes, then accuracy, macro and weighted averages."""
    scores = class_scores(df, label, prediction)
    weight = F.col("support") / F.sum("support").over(Window.partitionBy())  # a row per class
    weighted = scores.withColumn("_w", weight)
    per_class = scores.select("label", "precision", "recall", "f1", "support")
    total = F.sum("support").alias("support")
    accuracy = F.sum("tp") / F.sum("support")
    summary = [
        scores.agg(F.lit("accuracy").alias("label"), accuracy.alias("precision"),
                   accuracy.alias("recall"), accuracy.alias("f1"), total),
        scores.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total),
        weighted.agg(F.lit("weighted avg").alias("label"), *[
            F.sum(F.col(c) * F.col("_w")).alias(c) for c in ("precision", "recall", "f1")], total),
    ]
    out = reduce(DataFrame.unionByName, summary, per_class)
    return out.withColumns({c: F.round(c, digits) for c in ("precision", "recall", "f1")})


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """Share of items on which two models agree."""
    same = F.col(first).eqNullSafe(F.col(second)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_samples"), F.round(F.avg(same), 4).alias("agreement_rate"))


def model_benchmark(df: DataFrame, truth: str, first: str, second: str) -> DataFrame:
    """Agreement, and macro-F1 of both models only if every item has its truth."""
    complete = df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.round(F.avg(F.col(first).eqNullSafe(F.col(second)).cast("int")), 4).alias("agreement_rate"),
        (F.count(truth) == F.count(F.lit(1))).alias("_complete"))
    f1 = [
        macro_scores(df, truth, model).select(F.round("f1_macro", 4).alias(out))
        for model, out in ((first, "f1_macro_first"), (second, "f1_macro_second"))
    ]
    row = complete.crossJoin(F.broadcast(f1[0])).crossJoin(F.broadcast(f1[1]))  # one row each
    gate = F.col("_complete")
    return row.select(
        "n_samples", "agreement_rate",
        F.when(gate, F.col("f1_macro_first")).alias("f1_macro_first"),
        F.when(gate, F.col("f1_macro_second")).alias("f1_macro_second"),
        F.when(gate, "macro-F1 against the given labels")
        .otherwise("labels incomplete: agreement only").alias("note"))


def signal_test(model: DataFrame, baseline: DataFrame, margin: float = SIGNAL_MARGIN) -> DataFrame:
    """Does the model beat the random baseline by more than the margin?"""
    return model.select(F.col("f1_macro").alias("f1_model")).crossJoin(
        F.broadcast(baseline.select(F.col("f1_macro").alias("f1_baseline")))  # one row
    ).select(
        F.round("f1_model", 4).alias("f1_model"), F.round("f1_baseline", 4).alias("f1_baseline"),
        F.round(F.col("f1_model") - F.col("f1_baseline"), 4).alias("gain"),
        (F.col("f1_model") - F.col("f1_baseline") > margin).alias("has_signal"))


def published_gap(scores: DataFrame, published: float = PUBLISHED_TONE_F1) -> DataFrame:
    """Distance of the measured macro-F1 to the published one."""
    return scores.select(
        F.round("f1_macro", 4).alias("f1_macro_on_real_data"),
        F.round(F.lit(published) - F.col("f1_macro"), 4).alias("gap"))


def best_model(table: DataFrame, measure: str, name: str = "model") -> DataFrame:
    """Model table, best first; ties by name."""
    return table.orderBy(F.col(measure).desc(), name)


def cluster_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information, from counts."""
    cells = pair_counts(df, label, cluster)
    rows = cells.groupBy("label").agg(F.sum("n").cast("double").alias("a"))
    cols = cells.groupBy("prediction").agg(F.sum("n").cast("double").alias("b"))

    def choose2(c: Column) -> Column:
        return c * (c - 1) / 2

    def plogp(c: Column) -> Column:
        return c * F.log(c)

    n = F.col("n").cast("double")
    sums = (
        cells.agg(F.sum(n).alias("N"), F.sum(choose2(n)).alias("s"), F.sum(plogp(n)).alias("h"))
        .crossJoin(F.broadcast(rows.agg(  # one row
            F.sum(choose2(F.col("a"))).alias("sa"), F.sum(plogp(F.col("a"))).alias("ha"),
            F.count(F.lit(1)).alias("ka"))))
        .crossJoin(F.broadcast(cols.agg(  # one row
            F.sum(choose2(F.col("b"))).alias("sb"), F.sum(plogp(F.col("b"))).alias("hb"),
            F.count(F.lit(1)).alias("kb"))))
    )
    total = F.col("N")
    expected = F.try_divide(F.col("sa") * F.col("sb"), choose2(total))
    ceiling = (F.col("sa") + F.col("sb")) / 2
    ari = F.coalesce(F.try_divide(F.col("s") - expected, ceiling - expected), F.lit(1.0))
    entropy_a = F.log(total) - F.col("ha") / total
    entropy_b = F.log(total) - F.col("hb") / total
    mutual = F.log(total) + (F.col("h") - F.col("ha") - F.col("hb")) / total
    both_single = (F.col("ka") == 1) & (F.col("kb") == 1)
    nmi = F.when(both_single, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(mutual, (entropy_a + entropy_b) / 2), F.lit(0.0)))
    return sums.select(
        F.col("kb").alias("n_clusters"), F.round(ari, 4).alias("ari"),
        F.round(F.greatest(nmi, F.lit(0.0)), 4).alias("nmi"))


def regression_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and R2 in one aggregate."""
    error = F.col(label) - F.col(prediction)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"))
