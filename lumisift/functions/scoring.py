"""Distance to score, boosts and explanations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def score_of(distance: Column, boost: float | Column = 1.0) -> Column:
    """``2 - d`` up to distance 1, ``1 / d`` beyond, times the boost.

    NaN sorts above every number in Spark, so it takes the second branch and stays NaN; an infinite
    distance scores 0; a missing distance has no score.
    """
    boost = boost if isinstance(boost, Column) else F.lit(float(boost))
    base = F.when(distance <= 1, F.lit(2.0) - distance).otherwise(F.lit(1.0) / distance)
    return F.when(distance.isNotNull(), base * boost)


def explanation(score: Column, boost: float) -> Column:
    """Why a row has its score; a row without a score did not match."""
    matched = score.isNotNull()
    details = F.when(F.lit(float(boost)) != 1.0, F.lit(float(boost)))
    return F.struct(
        matched.alias("matched"),
        F.coalesce(score, F.lit(0.0)).alias("value"),
        F.when(matched, details).alias("boost"),
        F.when(matched, score / F.lit(float(boost))).alias("image_score"),
        F.when(matched, F.lit("score of the image times the boost")).otherwise(F.lit("not a candidate of this clause")).alias("description"),
    )
