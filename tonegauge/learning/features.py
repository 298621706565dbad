"""Feature stages.  Fitted stages are plain Spark transformers, so pipelines save and load.

What the estimators here learn is small and bounded (a number per column or per
vocabulary entry); rows never leave the executors.
"""

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, OneHotEncoder,
    RegexTokenizer, SQLTransformer, StopWordsRemover, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tonegauge.functions.text import TOKEN
from tonegauge.operators.ordering import exact_quantiles
from tonegauge.operators.quality import assert_leakage_free
from tonegauge.operators.terms import corpus_vocabulary


class TextVectorizer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """M1: words and word pairs to L2-normalised TF-IDF, idf = ln((1 + n) / (1 + df)) + 1.

    One pass finds the vocabulary and its document counts; at most ``maxFeatures``
    of them reach the driver.  The fitted stages are Spark's own tokenizer, count
    vectorizer, element-wise product and normalizer.  English stop words are Spark's.
    """

    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary size", TypeConverters.toInt)
    grams = Param(Params._dummy(), "grams", "1 for words, 2 for words and pairs", TypeConverters.toInt)
    minDf = Param(Params._dummy(), "minDf", "documents a term must be in", TypeConverters.toInt)
    stopwords = Param(Params._dummy(), "stopwords", "drop English stop words", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, maxFeatures=5000, grams=2, minDf=1, stopwords=False):
        super().__init__()
        self._setDefault(maxFeatures=5000, grams=2, minDf=1, stopwords=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        name, grams = self.getInputCol(), self.getOrDefault(self.grams)
        stop = StopWordsRemover.loadDefaultStopWords("english") if self.getOrDefault(self.stopwords) else None
        found = corpus_vocabulary(
            dataset, name, grams, self.getOrDefault(self.maxFeatures), self.getOrDefault(self.minDf), stop,
        ).collect()
        return self.fitted([(r["term"], r["df"]) for r in found], dataset.count())

    def fitted(self, found: list[tuple[str, int]], n: int) -> PipelineModel:
        """The stages for terms with their document counts, in order, among n documents."""
        name, out, grams = self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.grams)
        stop = StopWordsRemover.loadDefaultStopWords("english") if self.getOrDefault(self.stopwords) else None
        words, listed, counted, weighted = (f"_{out}_{part}" for part in ("words", "grams", "counts", "weights"))
        stages = [RegexTokenizer(
            inputCol=name, outputCol=words, gaps=False, pattern=TOKEN, toLowercase=True)]
        if stop:
            stages.append(StopWordsRemover(inputCol=words, outputCol=words + "_kept", stopWords=stop))
            words += "_kept"
        if grams == 2:
            pairs = f"_{out}_pairs"
            stages += [NGram(n=2, inputCol=words, outputCol=pairs), SQLTransformer(
                statement=f"SELECT *, concat({words}, {pairs}) AS {listed} FROM __THIS__")]
            words = listed
        idf = [math.log((1 + n) / (1 + df)) + 1 for _, df in found]
        stages += [
            CountVectorizerModel.from_vocabulary([term for term, _ in found], words, counted),
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=counted, outputCol=weighted),
            Normalizer(inputCol=weighted, outputCol=out, p=2.0),
        ]
        return PipelineModel(stages=stages)


class FillAndScale(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Missing numbers to the exact median or to 0, then mean 0 and population std 1.

    The fitted stage is one SQL projection that adds ``<column>_scaled``.
    """

    fill = Param(Params._dummy(), "fill", "median or zero", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, fill="median"):
        super().__init__()
        self._setDefault(fill="median")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        names = self.getInputCols()
        wide = dataset.select(*[F.col(c).cast("double").alias(c) for c in names])
        if self.getOrDefault(self.fill) == "median":
            long = wide.unpivot([], names, "_column", "_value")
            found = {r["_column"]: r["m"] for r in
                     exact_quantiles(long, "_value", {"m": 0.5}, ["_column"]).collect()}
            fills = {c: found.get(c, 0.0) for c in names}
        else:
            fills = dict.fromkeys(names, 0.0)
        filled = [F.coalesce(F.col(c), F.lit(fills[c])) for c in names]
        stats = wide.agg(*[F.struct(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")).alias(c)
                           for c, v in zip(names, filled)]).first()
        parts = []
        for c in names:
            mean, std = stats[c]["mean"] or 0.0, stats[c]["std"] or 1.0
            parts.append(
                f"(coalesce(CAST(`{c}` AS DOUBLE), {fills[c]!r}D) - ({mean!r}D)) / {std!r}D AS `{c}_scaled`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


class FillMostFrequent(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Missing categories to the most frequent value, ties alphabetically; adds ``<column>_filled``."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        names = self.getInputCols()
        long = dataset.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot(
            [], names, "_column", "_value")
        counts = long.where(F.col("_value").isNotNull()).groupBy("_column", "_value").agg(
            F.count(F.lit(1)).alias("_n"))
        best = counts.groupBy("_column").agg(
            F.min_by("_value", F.struct(-F.col("_n"), F.col("_value"))).alias("_best"))
        found = {r["_column"]: r["_best"] for r in best.collect()}  # one row per column
        parts = [
            "coalesce(CAST(`{0}` AS STRING), '{1}') AS `{0}_filled`".format(
                c, found.get(c, "").replace("\\", "\\\\").replace("'", "\\'"))
            for c in names]
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


class TruncatedSvd(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Projection on the k leading right singular vectors, without centring.

    The products of columns are summed on the distributed rows; the driver gets the
    vocabulary x vocabulary matrix and decomposes it.
    """

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, k=50):
        super().__init__()
        self._setDefault(k=50)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        rows = MLUtils.convertVectorColumnsFromML(
            dataset.select(F.col(self.getInputCol()).alias("v")), "v").persist()
        # One pass: the right singular vectors are the eigenvectors of X'X, whose size is the
        # square of the vocabulary (its documented bound, max_features).
        k, matrix = self.getOrDefault(self.k), RowMatrix(rows)
        _, vectors = np.linalg.eigh(matrix.computeGramianMatrix().toArray())
        factor = vectors[:, ::-1][:, :k]
        rows.unpersist()
        # Signs are arbitrary; the largest entry of each component is made positive.
        signs = np.sign(factor[np.abs(factor).argmax(axis=0), range(factor.shape[1])])
        return TruncatedSvdModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
            factor=(factor * signs).ravel().tolist(), k=factor.shape[1])


class TruncatedSvdModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    factor = Param(Params._dummy(), "factor", "right singular vectors, row by row",
                   TypeConverters.toListFloat)
    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, factor=None, k=None):
        super().__init__()
        self._set(**{name: v for name, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        factor = np.asarray(self.getOrDefault(self.factor)).reshape(-1, self.getOrDefault(self.k))

        @F.pandas_udf(ArrayType(DoubleType()))
        def project(batch: pd.Series) -> pd.Series:
            return pd.Series(list(np.stack(batch.to_list()) @ factor)) if len(batch) else batch

        arrays = vector_to_array(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(arrays)))


def text_stages(
    text: str = "text_content", out: str = "features", max_features: int = 5000,
    grams: int = 2, min_df: int = 1, stopwords: bool = False,
) -> list:
    return [TextVectorizer(inputCol=text, outputCol=out, maxFeatures=max_features, grams=grams,
                           minDf=min_df, stopwords=stopwords)]


def reduced_text_stages(
    text: str = "text_content", out: str = "features", max_features: int = 3000, components: int = 50,
) -> list:
    """M2: TF-IDF without stop words, reduced by truncated SVD."""
    return text_stages(text, "tfidf", max_features, 2, 1, True) + [
        TruncatedSvd(inputCol="tfidf", outputCol=out, k=components)]


def context_stages(names: list[str], out: str = "features") -> list:
    """M4: missing to 0, standardised, assembled."""
    return [
        FillAndScale(inputCols=names, fill="zero"),
        VectorAssembler(inputCols=[f"{c}_scaled" for c in names], outputCol=out),
    ]


def mixed_stages(
    text: str, categories: list[str], numbers: list[str], out: str = "features",
    max_features: int = 1000, grams: int = 2, min_df: int = 2,
) -> list:
    """M3: text, one-hot categories (unknown ones become zeros) and scaled numbers.

    Refuses features that exist only after publishing.
    """
    assert_leakage_free([text, *categories, *numbers])
    filled = [f"{c}_filled" for c in categories]
    indexed = [f"{c}_index" for c in categories]
    onehot = [f"{c}_onehot" for c in categories]
    return [
        *text_stages(text, "text_vector", max_features, grams, min_df, True),
        FillMostFrequent(inputCols=categories),
        # 'keep' puts unknown values in an extra last category, which dropLast removes.
        StringIndexer(inputCols=filled, outputCols=indexed, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=onehot, dropLast=True),
        FillAndScale(inputCols=numbers, fill="median"),
        VectorAssembler(inputCols=["text_vector", *onehot, *[f"{c}_scaled" for c in numbers]], outputCol=out),
    ]


def text_with_manual_stages(text: str, manual: list[str], out: str = "features", max_features: int = 5000) -> list:
    """TF-IDF and scaled hand-made features side by side."""
    return [
        *text_stages(text, "text_vector", max_features),
        FillAndScale(inputCols=manual, fill="zero"),
        VectorAssembler(inputCols=["text_vector", *[f"{c}_scaled" for c in manual]], outputCol=out),
    ]
