"""Equi joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that may stay together; a key with more is split into pieces of this size.
PIECE_ROWS = 1_000_000
# Keys marked for splitting at most: where all rows make more pieces, pieces grow to
# 1 / MARKED_KEYS of the rows, and no more keys than that can have so many.
MARKED_KEYS = 1_000_000

# Rows without a key match nothing, but must not all meet in one partition either.
NULL_SALTS = 1_000


def key_histogram(df: DataFrame, key: str) -> DataFrame:
    """``key, key_rows``: rows per key, combined before the shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("key_rows"))


def heavy_keys(
    histogram: DataFrame, key: str, rows: str = "key_rows", piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """``key, salts`` of all keys with more rows than a piece holds."""
    every = histogram.agg(F.sum(rows)).scalar()
    piece = F.greatest(F.lit(piece_rows), F.ceil(every / MARKED_KEYS))
    return histogram.where(F.col(rows) > piece).select(key, F.ceil(F.col(rows) / piece).cast("int").alias("salts"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    *,
    spread: list[Column],
    histogram: DataFrame | None = None,
    rows: str = "key_rows",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Join on ``key``, with the heavy keys of the left side spread over several partitions.

    Left rows of a heavy key take one of its salts, chosen by a hash of ``spread`` (columns that
    differ between such rows; a hash, so that a recomputed task picks the same salt). Right rows
    of a heavy key are repeated once per salt. ``histogram`` gives ``key, rows`` where counts are
    already known; keys it misjudges still join exactly.

    The marked keys are broadcast: by the size of a piece there are at most MARKED_KEYS of them,
    and since each occurs over ``piece_rows`` times, their text is under that part of the data. How to run the join
    itself Spark decides by the sizes it measures. Use ``left``, ``left_anti`` or ``left_semi``: none
    lets it build a hash table of the large side.
    """
    if histogram is None:
        histogram = key_histogram(left, key)
    heavy = F.broadcast(heavy_keys(histogram, key, rows, piece_rows))
    salts = F.when(F.col(key).isNull(), NULL_SALTS).otherwise(F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*spread), salts).cast("int")
    salted = left.join(heavy, key, "left").withColumn("salt", salt).drop("salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    repeated = right.join(heavy, key, "left").withColumn("salt", copies).drop("salts")
    return salted.join(repeated, [key, "salt"], how).drop("salt")
