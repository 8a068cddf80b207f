"""The grid of searches a study asks for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.functions.values import date_windows, distinct_texts, stable_id, text_array

# Result orders the API knows.
SEARCH_ORDERS = {"date", "rating", "relevance", "title", "viewCount"}


def search_grid(
    themes: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    window_days: int = 30,
    orders: Sequence[str] = ("relevance",),
) -> DataFrame:
    """One row per theme, query, order and date window, with the search id.

    ``themes`` holds ``theme`` and ``queries`` (array); queries are trimmed and de-duplicated.
    """
    invalid = [o for o in orders if o not in SEARCH_ORDERS]
    if invalid:
        raise ValueError(f"unknown search orders: {invalid}")
    grid = (
        themes.select("theme", F.explode(distinct_texts(F.col("queries"))).alias("query"))
        .select("*", F.explode(text_array(list(orders))).alias("search_order"))
        .select("*", F.explode(date_windows(start_date, end_date, window_days)).alias("w"))
        .select("theme", "query", "search_order", "w.*")
    )
    parts = ("theme", "query", "search_order", "published_after", "published_before")
    return grid.select(stable_id(*[F.col(c) for c in parts]).alias("search_id"), *parts)


def search_plan(
    spark: SparkSession, themes: Mapping[str, Sequence[str]], **grid_options
) -> DataFrame:
    """The grid for a study's themes and queries."""
    if not themes or not all(any(q.strip() for q in qs) for qs in themes.values()):
        raise ValueError("every theme needs at least one query")
    table = spark.createDataFrame(
        [(t, list(qs)) for t, qs in themes.items()], "theme string, queries array<string>")
    return search_grid(table, **grid_options)


def request_parameters(
    grid: DataFrame,
    max_results_per_page: int = 50,
    region_code: str | None = "BR",
    relevance_language: str | None = "pt",
) -> DataFrame:
    """The grid with the JSON of its request parameters; parameters without a value are left out."""
    if not 1 <= max_results_per_page <= 50:
        raise ValueError("max_results_per_page must be between 1 and 50")
    params = F.struct(
        F.lit("snippet").alias("part"),
        F.col("query").alias("q"),
        F.lit("video").alias("type"),
        F.lit(max_results_per_page).alias("maxResults"),
        F.col("search_order").alias("order"),
        F.col("published_after").alias("publishedAfter"),
        F.col("published_before").alias("publishedBefore"),
        F.lit(region_code).cast("string").alias("regionCode"),
        F.lit(relevance_language).cast("string").alias("relevanceLanguage"),
    )
    return grid.withColumn("request", F.to_json(params, {"ignoreNullFields": "true"}))
