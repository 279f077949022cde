"""The one-row governance record and its long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opinionlake import fixed
from opinionlake.functions.numbers import pct, share, verdict_class
from opinionlake.operators.dedup import key_counts
from opinionlake.operators.language import looks_spanish
from opinionlake.operators.outliers import iqr_bounds, outlier_stats
from opinionlake.operators.quantiles import group_lookup, same_group_join
from opinionlake.operators.quality import TIME_COLUMNS, compliance_columns, null_rate, schema_compliant, time_columns

OUTLIER_CHECKS = {"reading_time_min": fixed.ARTICLES, "score": fixed.POSTS, "num_comments": fixed.POSTS}


def _length_columns(sources: Sequence[str]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for suffix, n in [("", F.col("_len"))] + [(f"_{s}", F.when(F.col("source") == s, F.col("_len"))) for s in sources]:
        out[f"text_length_mean{suffix}"] = F.round(F.avg(n), 2)
        out[f"text_length_median{suffix}"] = F.round(F.percentile(n, F.lit(0.5)), 2)
        out[f"text_length_min{suffix}"] = F.min(n)
        out[f"text_length_max{suffix}"] = F.max(n)
    return out


def governance(df: DataFrame, run_ts: str, before: DataFrame | None = None,
               sources: Sequence[str] = fixed.SOURCES, outliers: dict[str, str] | None = None) -> DataFrame:
    """All KPIs of a gold table in a fixed schema; null where a KPI cannot be computed.

    One pass computes everything that is a plain aggregate.  Outlier bounds and
    key counts need a shuffle of one narrow column each and enter as scalars.
    ``before`` is the table before the global deduplication; without it the
    duplicate rate describes repeats inside ``df`` (the form for a chosen scope).
    """
    outliers = OUTLIER_CHECKS if outliers is None else outliers
    rows = F.count(F.lit(1))
    spanish = share(F.col("_spanish"))
    columns: dict[str, Column] = {
        "pipeline_run_ts": F.lit(run_ts),
        "total_records": rows,
        **{f"records_{s}": F.count(F.when(F.col("source") == s, 1)) for s in sources},
        "body_text_missing_rate": F.round(share(F.col("body_text_missing")), 2),
        "schema_compliance_rate": F.round(share(F.col("_compliant")), 2),
        **time_columns("published_at"),
        "pct_likely_spanish": F.round(spanish, 2),
        "pct_likely_english": F.round(100 - spanish, 2),
        **{f"null_rate_{c}": null_rate(c) for c in fixed.NULL_CHECKED},
        "token_count_mean": F.round(F.avg("token_count"), 2),
        "token_count_std": F.round(F.stddev_samp("token_count"), 2),
        "token_count_min": F.min("token_count"),
        "token_count_max": F.max("token_count"),
        **_length_columns(sources),
        **{f"sentiment_pct_{v}": F.round(pct(F.count(F.when(F.col("sentiment_label") == v, 1)), F.count("sentiment_label")), 2)
           for v in fixed.LABELS},
        "compound_mean": F.round(F.avg("vader_compound"), 4),
        "compound_std": F.round(F.stddev_samp("vader_compound"), 4),
        **compliance_columns("bronze_source", "source", sources, fixed.EXPECTED_RUNS),
    }
    prepared = df.withColumns({
        "_len": F.length("body_text_clean"), "_spanish": looks_spanish(F.col("body_text")),
        "_compliant": schema_compliant(fixed.REQUIRED),
    })
    one = prepared.agg(*[c.alias(name) for name, c in columns.items()])

    if before is not None:
        one = one.withColumn("records_before_dedup", before.agg(F.count(F.lit(1))).scalar())
        removed = F.greatest(F.col("records_before_dedup") - F.col("total_records"), F.lit(0))
        one = one.withColumns({
            "records_after_dedup": F.col("total_records"), "duplicates_removed": removed,
            "duplicate_rate": F.round(pct(removed, F.col("records_before_dedup")), 2)})
    else:
        keys = key_counts(df, "url").select(F.struct("rows", "distinct_keys").alias("k")).scalar()
        absent = F.lit(None).cast("long")
        one = one.withColumn("_k", keys).withColumns({
            "records_before_dedup": absent, "records_after_dedup": absent, "duplicates_removed": absent,
            "duplicate_rate": F.round(pct(F.col("_k.rows") - F.col("_k.distinct_keys"), F.col("_k.rows")), 2)}).drop("_k")

    found = outlier_stats(df, {c: F.col("source") == s for c, s in outliers.items()})
    per_column = found.agg(*[F.max(F.when(F.col("column_name") == c, F.struct("outlier_rate", "lower", "upper"))).alias(c)
                             for c in outliers])
    one = one.withColumn("_o", per_column.select(F.struct(*outliers)).scalar())
    for c in outliers:
        one = one.withColumns({f"outlier_rate_{c}": F.col(f"_o.{c}.outlier_rate"),
                               f"outlier_iqr_lower_{c}": F.round(f"_o.{c}.lower", 2),
                               f"outlier_iqr_upper_{c}": F.round(f"_o.{c}.upper", 2)})
    return one.select(*governance_columns(sources, outliers))


def governance_columns(sources: Sequence[str] = fixed.SOURCES, outliers: dict[str, str] | None = None) -> list[str]:
    outliers = OUTLIER_CHECKS if outliers is None else outliers
    stats = ("mean", "median", "min", "max")
    return [
        "pipeline_run_ts", "total_records", *[f"records_{s}" for s in sources],
        "body_text_missing_rate", "schema_compliance_rate",
        "records_before_dedup", "records_after_dedup", "duplicates_removed", "duplicate_rate",
        *TIME_COLUMNS, "pct_likely_spanish", "pct_likely_english",
        *[f"null_rate_{c}" for c in fixed.NULL_CHECKED],
        "token_count_mean", "token_count_std", "token_count_min", "token_count_max",
        *[f"text_length_{s}" for s in stats], *[f"text_length_{s}_{src}" for src in reversed(sources) for s in stats],
        *[f"sentiment_pct_{v}" for v in fixed.LABELS], "compound_mean", "compound_std",
        *[f"outlier_{part}_{c}" for c in outliers for part in ("rate", "iqr_lower", "iqr_upper")],
        *[f"actual_runs_{s}" for s in reversed(sources)], "expected_runs_weekly",
        *[f"ingestion_compliance_{s}" for s in reversed(sources)],
    ]


# --- any sources ------------------------------------------------------------
def source_records(df: DataFrame, by: str = "source", lineage: str = "bronze_source", expected: int = fixed.EXPECTED_RUNS,
                   outliers: Sequence[str] = tuple(OUTLIER_CHECKS)) -> DataFrame:
    """The KPIs of all rows together (``is_total``) and of each source that is found, however many there are.

    Plain aggregates of the whole and of the sources come from one pass with grouping
    sets over narrow columns; bounds of outliers are the exact quantiles of each
    source and column.  Distinct keys and files are counted by passes of their own: beside
    them, every plain aggregate would be shuffled once per key.  Rows without a source form a group whose ``source`` is null.
    """
    rows, label = F.count(F.lit(1)), F.col("sentiment_label")
    checked = [c for c in fixed.NULL_CHECKED if c not in ("url", by, lineage)]
    narrow = df.select(
        by, lineage, "url", "published_at", "body_text_missing", "token_count", "sentiment_label", "vader_compound",
        *[F.when(F.col(c).isNotNull(), 1).alias(f"_held_{c}") for c in checked],
        F.length("body_text_clean").alias("_len"), looks_spanish(F.col("body_text")).alias("_spanish"),
        schema_compliant(fixed.REQUIRED).alias("_compliant"))
    spanish, total, runs = share(F.col("_spanish")), F.col("total_records"), F.col("_runs")
    held = {**{c: F.col(f"_held_{c}") for c in checked}, **{c: F.col(c) for c in fixed.NULL_CHECKED if c not in checked}}
    plain = {
        "total_records": rows, "body_text_missing_rate": F.round(share(F.col("body_text_missing")), 2),
        "schema_compliance_rate": F.round(share(F.col("_compliant")), 2),
        # the key of rows without one counts once
        "_unkeyed": F.max(F.when(F.col("url").isNull(), 1).otherwise(0)),
        **time_columns("published_at"),
        "pct_likely_spanish": F.round(spanish, 2), "pct_likely_english": F.round(100 - spanish, 2),
        **{f"null_rate_{c}": F.round(share(held[c].isNull()), 2) for c in fixed.NULL_CHECKED},
        "token_count_mean": F.round(F.avg("token_count"), 2), "token_count_std": F.round(F.stddev_samp("token_count"), 2),
        "token_count_min": F.min("token_count"), "token_count_max": F.max("token_count"),
        "text_length_mean": F.round(F.avg("_len"), 2), "text_length_median": F.round(F.percentile("_len", F.lit(0.5)), 2),
        "text_length_min": F.min("_len"), "text_length_max": F.max("_len"),
        **{f"n_{v}": F.count(F.when(label == v, 1)) for v in fixed.LABELS}, "n_labelled": F.count(label),
        "compound_mean": F.round(F.avg("vader_compound"), 4), "compound_std": F.round(F.stddev_samp("vader_compound"), 4),
    }

    def counted(**aggregates: Column) -> DataFrame:
        return narrow.groupingSets([[], [by]], by).agg((F.grouping(by) == 1).alias("is_total"), *[c.alias(name) for name, c in aggregates.items()])

    grouped = counted(**plain)
    for distinct in (counted(_keys=F.count_distinct("url")), counted(_runs=F.count_distinct(lineage))):
        grouped = same_group_join(grouped, distinct, [by, "is_total"])
    in_place = {"_unkeyed": F.round(pct(total - (F.col("_keys") + F.col("_unkeyed")), total), 2).alias("duplicate_rate")}
    grouped = grouped.select(
        by, "is_total", *[in_place.get(name, F.col(name)) for name in plain],
        runs.alias("actual_runs"), F.lit(expected).alias("expected_runs_weekly"),
        F.round(F.least(runs * F.lit(100.0) / expected, F.lit(100.0)), 2).alias("ingestion_compliance"))
    # on equal counts the alphabetically first label dominates
    ranked = F.array(*[F.struct(F.col(f"n_{v}").alias("n"), F.lit(-i).alias("o"), F.lit(v).alias("label"))
                       for i, v in enumerate(sorted(fixed.LABELS))])
    top, labelled = F.array_max(ranked), F.col("n_labelled")
    shown = grouped.withColumns({
        **{f"sentiment_pct_{v}": F.round(pct(F.col(f"n_{v}"), labelled), 2) for v in fixed.LABELS},
        "dominant": F.when(labelled > 0, top["label"]), "dominant_pct": F.round(pct(top["n"], labelled), 1),
        "verdict": verdict_class(F.round("compound_mean", 3))}).drop(*[f"n_{v}" for v in fixed.LABELS], "n_labelled")
    return same_group_join(shown, _outliers_by_source(df, by, outliers), [by, "is_total"]) if outliers else shown


def _outliers_by_source(df: DataFrame, by: str, checks: Sequence[str]) -> DataFrame:
    """Outlier rate and bounds of each checked column, for all rows and for each source."""
    scopes = F.array(F.struct(F.lit(True).alias("is_total"), F.lit(None).cast(df.schema[by].dataType).alias(by)),
                     F.struct(F.lit(False).alias("is_total"), F.col(by).alias(by)))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in checks])
    values = df.select(F.explode(scopes).alias("scope"), cells.alias("cells")).select("scope.*", F.inline("cells")).filter(F.col("v").isNotNull())
    group = [by, "is_total", "column_name"]
    bounds = iqr_bounds(values, "v", group)
    flagged = group_lookup(values, bounds, group)
    counted = flagged.groupBy(*group).agg(
        F.round(share((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper"))), 2).alias("rate"),
        F.round(F.max("lower"), 2).alias("lower"), F.round(F.max("upper"), 2).alias("upper"))
    return counted.groupBy(by, "is_total").agg(*[
        F.max(F.when(F.col("column_name") == c, F.col(part))).alias(f"outlier_{name}_{c}")
        for c in checks for part, name in (("rate", "rate"), ("lower", "iqr_lower"), ("upper", "iqr_upper"))])


# --- long form --------------------------------------------------------------
def kpis_long(gov: DataFrame) -> DataFrame:
    """(metric, text, number): one row per KPI of the one-row record."""
    cells = []
    for field in gov.schema.fields:
        numeric = isinstance(field.dataType, T.NumericType)
        cells.append(F.struct(
            F.lit(field.name).alias("metric"), F.col(field.name).cast("string").alias("text"),
            (F.col(field.name).cast("double") if numeric else F.lit(None).cast("double")).alias("number")))
    return gov.select(F.inline(F.array(*cells)))


def categorize_metric(metric: Column) -> Column:
    def starts(*prefixes: str) -> Column:
        found = F.lit(False)
        for prefix in prefixes:
            found = found | F.startswith(metric, F.lit(prefix))
        return found

    return (F.when(metric.isin(*fixed.KPI_CORE), "Core")
            .when(starts("null_rate_"), "Completeness")
            .when(starts("outlier_rate_"), "Quality")
            .when(starts("ingestion_", "actual_runs_", "expected_runs_"), "Ingestion")
            .when(starts("text_length_", "token_count_"), "Text")
            .when(starts("sentiment_pct_", "compound_"), "Distribution")
            .otherwise("Other"))


def humanize_metric(metric: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in fixed.KPI_NAMES.items() for x in pair])

    def rest(prefix: str) -> Column:
        return F.replace(F.replace(metric, F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" "))

    return F.coalesce(
        F.try_element_at(known, metric),
        F.when(F.startswith(metric, F.lit("null_rate_")), F.concat(F.lit("Null rate - "), rest("null_rate_")))
        .when(F.startswith(metric, F.lit("outlier_rate_")), F.concat(F.lit("Outlier rate - "), rest("outlier_rate_")))
        .otherwise(F.initcap(F.replace(metric, F.lit("_"), F.lit(" ")))))


def format_value(metric: Column, text: Column, number: Column) -> Column:
    rate = (F.endswith(metric, F.lit("_rate")) | F.startswith(metric, F.lit("null_rate_"))
            | F.startswith(metric, F.lit("outlier_rate_")) | F.startswith(metric, F.lit("ingestion_compliance_")))
    return (F.when(text.isNull(), "N/A")
            .when(F.endswith(metric, F.lit("_ts")) | number.isNull(), text)
            .when(rate, F.concat(F.format_string("%.2f", number), F.lit("%")))
            .when(metric.isin(*fixed.KPI_WHOLE_NUMBERS), F.format_number(number, 0))
            .when(F.abs(number) < 1000, F.format_number(number, 2))
            .otherwise(F.format_number(number, 0)))


def kpi_table(gov: DataFrame) -> DataFrame:
    """Category, KPI, Value, RawMetric in category order, then by name."""
    metric, category = F.col("metric"), categorize_metric(F.col("metric"))
    order = F.array_position(F.array(*[F.lit(c) for c in fixed.KPI_CATEGORY_ORDER]), F.col("Category"))
    return (kpis_long(gov).filter(metric != "pipeline_run_ts")
            .select(category.alias("Category"), humanize_metric(metric).alias("KPI"),
                    format_value(metric, F.col("text"), F.col("number")).alias("Value"), metric.alias("RawMetric"))
            .orderBy(order, "KPI"))


def kpi_subset(kpis: DataFrame, prefix: str) -> DataFrame:
    return kpis.filter(F.startswith("metric", F.lit(prefix)))


def kpi_matrix(kpis: DataFrame, prefix: str = "text_length_", default: str = "global",
               metrics: Sequence[str] = ("mean", "median", "min", "max")) -> DataFrame:
    """``<prefix><metric>[_<source>]`` spread to a source by metric matrix."""
    parts = F.split(F.substring("metric", len(prefix) + 1, 1000), "_")
    return (kpi_subset(kpis, prefix)
            .select(F.get(parts, F.lit(0)).alias("m"), F.coalesce(F.get(parts, F.lit(1)), F.lit(default)).alias("source"), "number")
            .groupBy("source").pivot("m", list(metrics)).agg(F.max("number")))
