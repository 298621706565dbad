"""They must equal the published data contract for results to match."""

# Comment-corpus platform codes.  Code 1 is control text, never analysed.
PLATFORM_CODES = {0: "reddit", 1: "reference", 2: "twitter", 3: "youtube"}
ANALYSED_PLATFORMS = ["reddit", "twitter", "youtube"]

# Columns a raw posts source must have.
REQUIRED_POST_COLUMNS = [
    "post_id", "timestamp", "platform", "text_content", "sentiment_score",
    "sentiment_label", "toxicity_score", "likes_count", "shares_count",
    "comments_count", "impressions", "engagement_rate", "brand_name",
    "campaign_name", "campaign_phase",
]

# Metric columns that are coerced to numbers.
METRIC_COLUMNS = [
    "likes_count", "shares_count", "comments_count", "impressions",
    "engagement_rate", "sentiment_score", "toxicity_score",
]

# Columns known only after publishing, as the quality report flags them.
LEAKAGE_COLUMNS = [
    "likes_count", "shares_count", "comments_count", "impressions",
    "engagement_rate", "total_interactions", "er_recalc", "er_normalized",
    "composite_score", "sentiment_score", "toxicity_score", "sentiment_label",
    "toxicity_bin", "log_engagement", "authentic_success",
    "authentic_success_ev3",
]

# The audit for the success model, forbidden and allowed columns.
FORBIDDEN_FEATURES = [
    "likes_count", "shares_count", "comments_count", "impressions",
    "engagement_rate", "total_interactions", "er_recalc", "er_normalized",
    "er_segment", "composite_score", "sentiment_score", "toxicity_score",
    "sentiment_label", "toxicity_bin", "authentic_success", "log_engagement",
]
ALLOWED_FEATURES = [
    "text_content", "platform", "brand_name", "campaign_phase", "language",
    "day_of_week", "hour", "month", "country_norm", "platform_norm",
]

# Columns dropped before the tone model, with the kind of reason.
DROPPED_COLUMNS = {
    "post_id": "identifier", "user_id": "identifier",
    "sentiment_score": "leakage", "timestamp": "no signal",
    "language": "metadata", "location": "high cardinality",
    "brand_name": "bias", "product_name": "high cardinality",
    "campaign_name": "high cardinality", "hashtags": "noise",
    "mentions": "noise", "keywords": "redundant",
    "likes_count": "after publishing", "shares_count": "after publishing",
    "comments_count": "after publishing", "impressions": "after publishing",
    "engagement_rate": "other question", "buzz_change_rate": "metadata",
    "user_past_sentiment_avg": "user history",
    "user_engagement_growth": "user history", "day_of_week": "no signal",
    "topic_category": "crossing variable", "emotion_type": "leakage",
    "campaign_phase": "metadata",
}

# Attributes of the provisional campaign dimension.
CAMPAIGN_OBJECTIVES = ["awareness", "conversion", "retention", "launch", "support"]
CAMPAIGN_SEGMENTS = ["masivo", "joven", "premium", "tecnico", "fidelizacion"]
CAMPAIGN_PRIORITIES = ["alta", "media", "baja"]
CAMPAIGN_SOURCE_TYPE = "simulated_csv_until_api_db_ready"
CAMPAIGN_BUDGET = (8000, 1750, 42000)  # base, step, modulus

# The provenance text of the success rule.
SUCCESS_RULE = "organic + engagement_p75 + positive_sentiment + toxicity_p40"

# Canonical tone labels.
TONE_LABELS = ["Negative", "Neutral", "Positive"]
LABEL_ALIASES = {
    "negative": "Negative", "neutral": "Neutral", "positive": "Positive",
    "label_0": "Negative", "label_1": "Neutral", "label_2": "Positive",
}
BENCHMARK_LABELS = {0: "Negative", 1: "Neutral", 2: "Positive"}

# Names of the six topic clusters.
TOPIC_NAMES = {
    0: "Experiencia producto nuevo", 1: "Pide opinion",
    2: "Reaccion a publicidad", 3: "Pide feedback", 4: "Eventos",
    5: "Invita a comentar",
}

# Weekday order of the timing reports.
WEEKDAYS = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]

# Keywords of the toxicity evidence table.
TOXICITY_KEYWORDS = ["hate", "bad", "terrible", "awful", "worst", "love", "great"]

# Stop words of the distinctive-term report.
TERM_STOPWORDS = """
the a an and or but if then else when while for to of in on at by with from
is are was were be been being do does did have has had this that these those
i you he she it we they me him her them my your his its our their as so not no
yes can will would could should may might must just like get got than too very
about into out up down over under again more most some any all what who which
""".split()

# Feature lists of the coherence classifier and engagement regressor.
COHERENCE_FEATURES = [
    "toxicity_score", "intensidad_sentimiento", "n_hashtags", "tiene_mencion",
    "es_fin_semana", "es_hora_laboral", "user_past_sentiment_avg",
    "user_engagement_growth", "buzz_change_rate",
]
ENGAGEMENT_FEATURES = [
    "sentiment_score", "toxicity_score", "coherencia_sentimiento",
    "intensidad_sentimiento", "n_hashtags", "tiene_mencion", "es_fin_semana",
    "es_hora_laboral", "user_past_sentiment_avg", "user_engagement_growth",
    "buzz_change_rate",
]

TOXIC_THRESHOLD = 0.5
PUBLISHED_TONE_F1 = 0.9366
SIGNAL_MARGIN = 0.05
SEED = 42
