"""Projections of the posts table.

Each transform adds its columns only when its inputs exist, as the data contract
allows sources with fewer columns; the test reads the schema and runs no job.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.constants import (
    ANALYSED_PLATFORMS, METRIC_COLUMNS, PLATFORM_CODES, SUCCESS_RULE,
)
from tonegauge.functions import labels, text
from tonegauge.functions.coerce import flag, to_moment, to_number
from tonegauge.operators.ordering import exact_quantiles


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def parse_timestamp(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, to_moment(df, name)) if has(df, name) else df


def add_calendar(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Year, month and hour, each only where the source lacks it."""
    parts = {"year": F.year, "month": F.month, "hour": F.hour}
    new = {c: fn(F.col(name)) for c, fn in parts.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def add_timing(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Day and month names, weekend and office-hour flags."""
    hour = F.hour(F.col(name))
    weekend = (
        F.col("day_of_week") if has(df, "day_of_week")
        else F.date_format(F.col(name).cast("timestamp"), "EEEE")
    ).isin("Saturday", "Sunday")
    return df.withColumns({
        "hora": hour,
        "dia_semana": F.date_format(F.col(name).cast("timestamp"), "EEEE"),
        "mes": F.date_format(F.col(name).cast("timestamp"), "MMMM"),
        "es_fin_semana": flag(weekend),
        "es_hora_laboral": flag(hour.between(9, 18)),
    })


def coerce_metrics(df: DataFrame, names: list[str] = METRIC_COLUMNS) -> DataFrame:
    new = {c: to_number(c) for c in names if c in df.columns}
    return df.withColumns(new) if new else df


def add_total_interactions(df: DataFrame, null_as_zero: bool = True) -> DataFrame:
    """Likes + shares + comments, missing counts as 0 or makes the total missing."""
    parts = ["likes_count", "shares_count", "comments_count"]
    if not has(df, *parts):
        return df
    cols = [F.col(c).cast("double") for c in parts]
    if null_as_zero:
        cols = [F.coalesce(c, F.lit(0.0)) for c in cols]
    return df.withColumn("total_interactions", cols[0] + cols[1] + cols[2])


def add_recalculated_rate(df: DataFrame, out: str = "er_recalc_ev3") -> DataFrame:
    """Interactions per impression, NULL where there is no impression."""
    if not has(df, "total_interactions", "impressions"):
        return df
    seen = F.col("impressions").cast("double")
    return df.withColumn(out, F.when(seen > 0, F.col("total_interactions") / seen))


def log10_engagement(rate: Column, null_as_zero: bool = True) -> Column:
    """log10 of the clipped rate plus one."""
    clipped = F.when(rate.isNotNull(), F.greatest(rate, F.lit(0.0)))
    if null_as_zero:
        clipped = F.coalesce(clipped, F.lit(0.0))
    return F.log10(clipped + 1)


def natural_log_engagement(rate: Column) -> Column:
    """P10: log1p; undefined below -1."""
    return F.when(rate > -1, F.log1p(rate))


def add_engagement_flags(df: DataFrame) -> DataFrame:
    """P9 and P11; a source without a rate has no fake posts."""
    if not has(df, "engagement_rate"):
        return df.withColumn("fake_engagement_flag", F.lit(0))
    return df.withColumns({
        "log_engagement": log10_engagement(F.col("engagement_rate")),
        "fake_engagement_flag": flag(F.col("engagement_rate") > 1),
    })


def organic(df: DataFrame, fake: str = "fake_engagement_flag") -> DataFrame:
    """Posts that are not flagged."""
    return df.where(F.col(fake) == 0)


def success_thresholds(df: DataFrame, organic_only: bool = True) -> DataFrame:
    """One row (engagement_p75, toxicity_p40), exact and interpolated.

    Both measures go through one ordered pass, as two groups of one column.
    """
    base = organic(df) if organic_only else df
    measures = base.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(c).alias("value"))
        for name, c in (("engagement", "engagement_rate"), ("toxicity", "toxicity_score"))])))
    levels = exact_quantiles(measures, "value", {"p75": 0.75, "p40": 0.40}, ["measure"])
    return levels.agg(
        F.max(F.when(F.col("measure") == "engagement", F.col("p75"))).alias("engagement_p75"),
        F.max(F.when(F.col("measure") == "toxicity", F.col("p40"))).alias("toxicity_p40"))


def flag_authentic_success(
    df: DataFrame, organic_only: bool = True, out: str = "authentic_success_ev3"
) -> DataFrame:
    """High engagement, positive tone and low toxicity; organic if asked."""
    if not has(df, "engagement_rate", "sentiment_score", "toxicity_score"):
        return df
    limits = F.broadcast(success_thresholds(df, organic_only))  # one row
    met = (
        (F.col("engagement_rate") >= F.col("engagement_p75"))
        & (F.col("sentiment_score") > 0)
        & (F.col("toxicity_score") <= F.col("toxicity_p40"))
    )
    if organic_only:
        met = met & (F.col("fake_engagement_flag") == 0)
    flagged = df.crossJoin(limits).withColumn(out, flag(met))
    if organic_only:
        flagged = flagged.withColumn("authentic_success_rule", F.lit(SUCCESS_RULE))
    return flagged.drop("engagement_p75", "toxicity_p40")


def add_coherence(df: DataFrame) -> DataFrame:
    """P16 and P17."""
    return df.withColumns({
        "coherencia_sentimiento": labels.coherence(
            F.col("sentiment_label"), F.col("toxicity_score")),
        "intensidad_sentimiento": F.abs("sentiment_score"),
    })


def add_context_counts(df: DataFrame) -> DataFrame:
    """Mention flag and number of comma-separated hashtags."""
    return df.withColumns({
        "mentions": F.coalesce("mentions", F.lit("none")),
        "tiene_mencion": flag(F.coalesce("mentions", F.lit("none")) != "none"),
        "n_hashtags": text.item_count(F.col("hashtags")),
    })


def add_text_counts(df: DataFrame) -> DataFrame:
    """P20-P22; a missing column counts as empty text."""
    col = {c: F.col(c) if c in df.columns else F.lit("")
           for c in ("text_content", "hashtags", "mentions")}
    return df.withColumns({
        "text_len": text.text_len(col["text_content"]),
        "word_count": text.word_count(col["text_content"]),
        "hashtag_count": text.char_count(col["hashtags"], "#"),
        "mention_count": text.char_count(col["mentions"], "@"),
        "has_question": text.has_char(col["text_content"], "?"),
        "has_exclamation": text.has_char(col["text_content"], "!"),
    })


def add_manual_text_features(df: DataFrame, name: str = "text_content") -> DataFrame:
    """The six hand-made features of the ablation."""
    col = F.col(name)
    return df.withColumns({
        "len_chars": text.text_len(col),
        "n_words": text.word_count(col),
        "n_exclaim": text.char_count(col, "!"),
        "n_question": text.char_count(col, "?"),
        "n_upper": text.upper_count(col),
        "avg_word_len": text.mean_word_length(col),
    })


def fill_text(df: DataFrame, name: str = "text_content") -> DataFrame:
    """Missing text becomes ''."""
    return df.na.fill({name: ""})


def require_text(df: DataFrame, name: str = "text_content") -> DataFrame:
    """Rows without text are left out."""
    return df.na.drop(subset=[name])


def map_platforms(
    df: DataFrame, name: str = "platform", out: str = "platform_name",
    codes: dict = PLATFORM_CODES, keep: list[str] = ANALYSED_PLATFORMS,
) -> DataFrame:
    """Platform names from codes or from text, whichever the source carries.

    The source counts as coded when more than half of its values are numbers;
    the share is one aggregate row, joined back as such.
    """
    number = to_number(F.col(name))
    share = df.agg(F.avg(number.isNotNull().cast("int")).alias("_coded"))
    named = F.when(F.col("_coded") > 0.5, labels.lookup(number, codes)).otherwise(
        F.lower(F.trim(F.col(name).cast("string"))))
    return (
        df.crossJoin(F.broadcast(share))  # one row
        .withColumn(out, named).drop("_coded").where(F.col(out).isin(keep))
    )


def clean_scores(df: DataFrame, name: str = "hate_speech_score") -> DataFrame:
    """Numeric score or no row."""
    return df.withColumn(name, to_number(name)).where(F.col(name).isNotNull())


def present(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def operational_extract(df: DataFrame, key: str, rows: int = 200) -> DataFrame:
    """The first rows of the operational columns, in key order."""
    wanted = present(df, [
        "platform", "brand_name", "campaign_phase", "sentiment_label",
        "engagement_rate", "toxicity_score", "authentic_success",
    ])
    return df.orderBy(key).limit(rows).select(key, *wanted)


def add_leakage_free_features(df: DataFrame) -> DataFrame:
    """All features known before publishing."""
    return (
        df.transform(parse_timestamp).transform(add_calendar).transform(add_timing)
        .transform(add_context_counts).transform(add_coherence)
    )
