"""The two comment-corpus reports, as one DataFrame per section."""

from pyspark.sql import DataFrame

from tonegauge.constants import ANALYSED_PLATFORMS, PLATFORM_CODES, TOXIC_THRESHOLD
from tonegauge.operators import describe, joins, posts, ranktests, terms
from tonegauge.sources import files, sinks


def analysed_comments(corpus: DataFrame, sequence: str) -> DataFrame:
    """One row per comment of the analysed platforms, with ``platform_name``."""
    files.toxicity_corpus(corpus)  # checks the columns
    slim = corpus.select("comment_id", "platform", "hate_speech_score", sequence)
    unique = joins.dedup_comments(slim, sequence).drop(sequence)
    return posts.clean_scores(posts.map_platforms(unique))


def platform_benchmark(comments: DataFrame) -> dict[str, DataFrame]:
    """Descriptive statistics, tests and reading of the platform comparison."""
    score, group = "hate_speech_score", "platform_name"
    pairs = ranktests.mann_whitney(comments, score, group, ANALYSED_PLATFORMS)
    ranking = describe.mean_ranking(comments, group, score)
    return {
        "descriptive": describe.score_summary(comments, group, score),
        "kruskal_wallis": ranktests.kruskal_wallis(comments, score, group, ANALYSED_PLATFORMS),
        "pairwise": ranktests.holm(pairs),
        "ranking": ranking,
        "reading": describe.ranking_reading(ranking, group, "twitter"),
    }


def explain(corpus: DataFrame, threshold: float = TOXIC_THRESHOLD, top: int = 15) -> dict[str, DataFrame]:
    """Why platforms differ: ranking, distribution, threshold share, terms."""
    named = {c: p for c, p in PLATFORM_CODES.items() if p in ANALYSED_PLATFORMS}
    df = files.explain_corpus(corpus, named)
    distribution = describe.score_distribution(df, "platform", "score", threshold)
    ranking = describe.mean_ranking(df, "platform", "score")
    return {
        "ranking": describe.relative_index(ranking, "platform"),
        "kruskal_wallis": ranktests.kruskal_wallis(df, "score", "platform", ANALYSED_PLATFORMS),
        "pairwise": ranktests.mann_whitney(df, "score", "platform", ANALYSED_PLATFORMS),
        "distribution": distribution,
        "tail": describe.tail_reading(distribution),
        "threshold": describe.threshold_share(df, "platform", "score", threshold),
        "terms": terms.distinctive_terms(
            df, "platform", ANALYSED_PLATFORMS, threshold=threshold, top=top),
    }


def write_sections(sections: dict[str, DataFrame], folder: str) -> None:
    for name, df in sections.items():
        sinks.write_report(df, f"{folder}/{name}")
