"""Bronze records to silver tables.

Each input file is one batch: repeats, medians and bounds are computed per file,
all files in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from opinionlake import fixed
from opinionlake.functions.numbers import to_double
from opinionlake.functions.text import (blank_if_null, body_from_paragraphs, clean_text, fill_author, first_int, is_blank)
from opinionlake.functions.timeparts import coalesce_ts, ts_from_epoch
from opinionlake.operators.conform import conform, drop_null_keys, meta_fields, tag_source
from opinionlake.operators.dedup import dedup_first
from opinionlake.operators.outliers import cap_outliers, impute_median
from opinionlake.schemas import SILVER_ARTICLE, SILVER_POST
from opinionlake.session import stored

BATCH = "bronze_source"


def typed_posts(bronze: DataFrame) -> DataFrame:
    """Types, sentinels and the empty-body flag; nothing removed yet."""
    return tag_source(bronze.withColumns({
        "published_at": ts_from_epoch(F.col("created_utc")),
        "body_text": blank_if_null(F.col("selftext")),
        "score": to_double(F.col("score")),
        "num_comments": to_double(F.col("num_comments")),
        "author": fill_author(F.col("author")),
        "body_text_missing": is_blank(F.col("selftext")),
    }), fixed.POSTS)


def silver_posts(bronze: DataFrame, order: Sequence[str], key: str = "url") -> DataFrame:
    """``order`` names the columns that give the row order inside a file."""
    # kept rows are read for the bounds and for the result
    kept = stored(drop_null_keys(dedup_first(typed_posts(bronze), [BATCH, key], order), key), "kept_posts")
    capped = cap_outliers(kept, ["score", "num_comments"], [BATCH])
    cleaned = capped.withColumns({
        "body_text_clean": clean_text(F.col("body_text"), social=True),
        "title_clean": clean_text(F.col("title"), social=True),
    })
    return conform(cleaned, SILVER_POST)


def typed_articles(bronze: DataFrame) -> DataFrame:
    """Fields taken out of metadata and paragraphs; nothing removed yet."""
    fallback = F.col("published_time") if "published_time" in bronze.columns else None
    fields = meta_fields(bronze.drop("title", "author"), "all_meta", {
        "title": fixed.META_TITLE, "author": fixed.META_AUTHOR,
        "_published": fixed.META_PUBLISHED, "_reading_time": fixed.META_READING_TIME,
    })
    typed = fields.withColumns({
        "body_text": body_from_paragraphs(F.col("p_all_texts")),
        "published_at": coalesce_ts(F.col("_published"), fallback),
        "reading_time_min": first_int(F.col("_reading_time")).cast("double"),
        "author": fill_author(F.col("author")),
    })
    return tag_source(typed.withColumn("body_text_missing", is_blank(F.col("body_text"))), fixed.ARTICLES)


def silver_articles(bronze: DataFrame, order: Sequence[str], key: str = "url") -> DataFrame:
    kept = stored(drop_null_keys(dedup_first(typed_articles(bronze), [BATCH, key], order), key), "kept_articles")
    # reading times are whole minutes: the built-in percentile sees few distinct values
    filled = impute_median(kept, "reading_time_min", [BATCH], small_domain=True)
    capped = cap_outliers(filled, ["reading_time_min"], [BATCH], small_domain=True)
    cleaned = capped.withColumns({
        "body_text_clean": clean_text(F.col("body_text")), "title_clean": clean_text(F.col("title")),
    })
    return conform(cleaned, SILVER_ARTICLE)
