"""Label, code and class expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonegauge.constants import LABEL_ALIASES, TOXIC_THRESHOLD
from tonegauge.functions.coerce import flag


def lookup(col: Column, table: dict) -> Column:
    """Constant dictionary as a CASE; unknown keys give NULL."""
    out = F.lit(None).cast("string")
    for key, value in reversed(list(table.items())):
        out = F.when(col == F.lit(key), F.lit(value)).otherwise(out)
    return out


def canonical_label(col: Column) -> Column:
    """Known spellings to the canonical tone, anything else capitalised."""
    raw = F.lower(F.trim(col))
    capitalised = F.concat(F.upper(F.substring(raw, 1, 1)), F.substring(raw, 2, 1 << 30))
    return F.coalesce(lookup(raw, LABEL_ALIASES), capitalised)


def tone_from_score(score: Column) -> Column:
    """Below -0.2 negative, above 0.2 positive, neutral between."""
    return (
        F.when(score < -0.2, "Negative").when(score > 0.2, "Positive")
        .when(score.isNotNull(), "Neutral")
    )


def toxicity_class(score: Column, threshold: float = TOXIC_THRESHOLD) -> Column:
    """P25: strictly above the threshold is 'alta', unknown counts as 'baja'."""
    return F.when(F.coalesce(score > threshold, F.lit(False)), "alta").otherwise("baja")


def toxicity_flag(score: Column, threshold: float = TOXIC_THRESHOLD) -> Column:
    return flag(score > threshold)


def coherence(label: Column, toxicity: Column) -> Column:
    """Does the tone go with the toxicity of the text?"""
    return flag(
        ((label == "Positive") & (toxicity < 0.5))
        | ((label == "Negative") & (toxicity > 0.3))
        | (label == "Neutral")
    )


def in_order(col: Column, order: list[str]) -> Column:
    """Sort key for a fixed category order; unknown values last."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), col)
    return F.when(position > 0, position).otherwise(F.lit(len(order) + 1))
