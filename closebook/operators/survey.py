"""Morale survey by department, with its trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.sources.relations import Relations


def morale_by_department(rel: Relations) -> DataFrame:
    """Responses and average score per department for every week and month.

    Responses are first summed per department and day; both grains are then
    sums over days, because a week may belong to two months.
    """
    days = (
        rel.survey.filter(F.col("score").isNotNull() & F.col("submitted_at").isNotNull())
        .groupBy("department", F.col("submitted_at").cast("date").alias("day"))
        .agg(F.count("*").alias("responses"), F.sum("score").alias("score_sum"))
    )
    periods = (
        days.selectExpr(
            "department", "responses", "score_sum",
            "stack(2, 'week', trunc(day, 'WEEK'), 'month', trunc(day, 'MONTH'))"
            " AS (grain, period_start)",
        )
        .groupBy("grain", "department", "period_start")
        .agg(F.sum("responses").alias("responses"), F.sum("score_sum").alias("score_sum"))
        .withColumn("avg_score", F.col("score_sum").cast("double") / F.col("responses"))
    )
    previous = F.lag("avg_score").over(
        Window.partitionBy("grain", "department").orderBy("period_start")
    )
    return periods.select(
        "grain", "department", "period_start", "responses",
        F.round("avg_score", 4).alias("avg_score"),
        F.round(F.col("avg_score") - previous, 4).alias("change"),
    )
