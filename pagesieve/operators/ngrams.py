"""Runs of neighbouring words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def runs_of(df: DataFrame, key: str, words: str, sizes: list[int]) -> DataFrame:
    """``key, size, place, gram``: every run of each size, made inside the row.

    Sizes and places are exploded, and a run is cut out of its list where it is written: a text's
    runs are never held together, and nothing is computed twice.
    """
    lists = df.select(key, F.col(words).alias("_words"), F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    last = F.size("_words") - F.col("size")
    placed = lists.where(last >= 0).select(key, "_words", "size", F.explode(F.sequence(F.lit(0), last)).alias("place"))
    gram = F.array_join(F.slice("_words", F.col("place") + 1, F.col("size")), " ")
    return placed.select(key, "size", "place", gram.alias("gram"))
