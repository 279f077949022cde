"""Declared schemas of the three layers."""

from pyspark.sql import types as T

from opinionlake.fixed import PAGE_TAGS

_TEXTS = T.ArrayType(T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


S, D, L, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()

BRONZE_POST = _struct(
    ("api_query", S), ("url", S), ("permalink", S), ("title", S), ("selftext", S), ("author", S),
    ("score", S), ("num_comments", S), ("created_utc", S), ("subreddit", S), ("retrieved_at", S), ("lang", S),
)

BRONZE_PAGE = _struct(
    ("url", S),
    *[(f"{tag}_all_texts", _TEXTS) for tag in PAGE_TAGS],
    ("all_hrefs", _TEXTS), ("all_src", _TEXTS), ("all_classes", _TEXTS),
    ("all_meta", T.MapType(S, S)), ("author", S), ("published_time", S),
    ("ingestion_timestamp", S), ("error", S), ("status", S),
)

# The same record when lists and the map were stored as text (CSV, older JSON).
BRONZE_PAGE_TEXT = T.StructType([T.StructField(f.name, S, True) for f in BRONZE_PAGE.fields])

API_PAYLOAD = _struct(
    ("data", _struct(
        ("children", T.ArrayType(_struct(
            ("data", _struct(
                ("title", S), ("selftext", S), ("permalink", S), ("url", S), ("author", S),
                ("score", S), ("num_comments", S), ("created_utc", S), ("subreddit", S),
            )),
        ))),
    )),
)

SILVER_POST = _struct(
    ("url", S), ("title", S), ("author", S), ("published_at", TS), ("body_text", S),
    ("body_text_clean", S), ("title_clean", S), ("body_text_missing", B), ("score", D),
    ("num_comments", D), ("subreddit", S), ("source", S), ("bronze_source", S),
)

SILVER_ARTICLE = _struct(
    ("url", S), ("title", S), ("author", S), ("published_at", TS), ("reading_time_min", D),
    ("body_text", S), ("body_text_clean", S), ("title_clean", S), ("body_text_missing", B),
    ("source", S), ("bronze_source", S),
)

GOLD_INPUT = _struct(
    ("url", S), ("title", S), ("author", S), ("published_at", TS), ("body_text", S),
    ("body_text_clean", S), ("title_clean", S), ("body_text_missing", B), ("source", S),
    ("bronze_source", S), ("score", D), ("num_comments", D), ("subreddit", S), ("reading_time_min", D),
)

GOLD_BASE = T.StructType(GOLD_INPUT.fields + _struct(
    ("text_processed", S), ("title_processed", S), ("token_count", T.IntegerType()),
    ("vader_compound", D), ("vader_pos", D), ("vader_neg", D), ("vader_neu", D), ("sentiment_label", S),
).fields)
