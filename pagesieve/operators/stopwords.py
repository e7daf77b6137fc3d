"""Word lists without stop words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.operators.skew import PIECE_ROWS, skew_join

# Word lists up to this size travel to every task as one array; longer ones are joined.
IN_ROW_WORDS = 20_000


def drop_stop_words(
    df: DataFrame,
    key: str,
    columns: list[str],
    stop_words: DataFrame,
    in_row_words: int = IN_ROW_WORDS,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Remove the stop words from the array ``columns``; what is left keeps its order.

    ``key`` must be unique. NULL is no stop word and stays. A list of checked size is filtered
    inside each row, with no shuffle; a longer one is joined, with the same outcome.
    """
    stop_words = stop_words.where(F.length("word") > 0)
    if stop_words.limit(in_row_words + 1).count() <= in_row_words:
        listed = stop_words.agg(F.collect_set("word")).scalar()
        kept = {
            name: F.filter(name, lambda word: word.isNull() | ~F.array_contains("_listed", word))
            for name in columns
        }
        return df.withColumn("_listed", listed).withColumns(kept).drop("_listed")
    for name in columns:
        df = _drop_by_join(df, key, name, stop_words, piece_rows)
    return df


def _drop_by_join(
    df: DataFrame, key: str, name: str, stop_words: DataFrame, piece_rows: int
) -> DataFrame:
    """Only the stop words that a row holds come back to it; its other words stay where they are."""
    order = df.columns
    distinct = df.select(key, F.explode(F.array_distinct(name)).alias("word")).where(F.col("word").isNotNull())
    held = skew_join(
        distinct,
        stop_words.distinct(),
        "word",
        "left_semi",
        spread=[F.col(key)],
        piece_rows=piece_rows,
    )
    lists = held.groupBy(key).agg(F.collect_list("word").alias("_held"))
    others = F.filter(name, lambda word: word.isNull() | ~F.array_contains("_held", word))
    return (
        df.join(lists, key, "left")
        .withColumn(name, F.when(F.col("_held").isNull(), F.col(name)).otherwise(others))
        .select(*order)
    )
