"""Exact top-n per group that never gathers a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SALT = "__salt"
RANK = "__rank"


def _ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= n)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str], salts: int = 64
) -> DataFrame:
    """Rows ranked ``<= n`` within ``group`` under ``order``.

    Up to the optimizer's own bound every task cuts its part of a group to ``n`` rows before the
    exchange, so one ranking is enough. Above it the rank is taken twice: first inside ``(group,
    salt)``, where the salt is a hash of the ``spread`` columns, then among the at most ``salts * n``
    survivors; a row among the best n of its group is among the best n of its part.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts))
        df = _ranked(df.withColumn(SALT, parts), [*group, SALT], order, n).drop(SALT, RANK)
    return _ranked(df, group, order, n).withColumn("rank", F.col(RANK).cast("bigint")).drop(RANK)
