"""From page features to the two word lists a classifier reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.functions.text import (
    ALIASES,
    HAN,
    concat_meta,
    join_words,
    keep_characters,
    letter_words,
    replace_aliases,
)
from pagesieve.operators.segment import segment
from pagesieve.operators.stopwords import drop_stop_words
from pagesieve.operators.tfidf import TOP_WORDS, top_words, word_lists

# Adds a word list for each text: columns maps the text's name to that of the list.
Splitter = Callable[[DataFrame, str, dict[str, str]], DataFrame]


def letter_splitter(min_length: int = 2) -> Splitter:
    """For texts that separate words: split on what is no letter."""

    def split(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
        return df.withColumns(
            {
                words: F.coalesce(
                    letter_words(F.col(text), min_length), F.array().cast("array<string>")
                )
                for text, words in columns.items()
            }
        )

    return split


def dictionary_splitter(dictionary: DataFrame) -> Splitter:
    """For texts that do not: the best path through ``word, freq``."""
    return lambda df, key, columns: segment(df, key, columns, dictionary)


@dataclass
class Cleaning:
    """How texts become words. The defaults are those for Han text."""

    splitter: Splitter
    #: The splitter joins, and so reads its rows more than once; else it works inside a row.
    costly: bool = True
    keep: str | None = HAN
    aliases: Iterable[tuple[str, str]] = ALIASES
    alias_meta: bool = True
    topn: int = TOP_WORDS
    min_tag_length: int = 2


def clean_text(
    df: DataFrame,
    key: str,
    stop_words: DataFrame,
    how: Cleaning,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """Add ``tag_words`` and ``meta_words`` (arrays) to rows with title, keywords, description
    and corpus; ``key`` must be unique.

    The body is cut to its top words first and loses stop words after that, so fewer may remain.
    The meta text is empty if any of its parts is NULL, and keeps all its words in order.
    ``frequencies`` fix the ranking from outside; without them the rows themselves give it.
    """

    def prepared(text, aliased):
        text = F.coalesce(text, F.lit(""))
        text = replace_aliases(text, how.aliases) if aliased else text
        return keep_characters(text, how.keep) if how.keep else text

    def with_meta(rows):
        meta = concat_meta(F.col("title"), F.col("keywords"), F.col("description"))
        rows = rows.withColumn("meta_text", prepared(meta, how.alias_meta))
        return how.splitter(rows, key, {"meta_text": "meta_words"}).drop("meta_text")

    body = df.select(key, prepared(F.col("corpus"), True).alias("body_text"))
    body = how.splitter(body, key, {"body_text": "body_words"}).select(
        key,
        F.filter("body_words", lambda word: F.length(word) >= how.min_tag_length).alias("body_words"),
    )
    ranked = top_words(body, key, "body_words", frequencies, how.topn)
    tags = word_lists(ranked, key, "rank", "tag_words")
    # Texts are shuffled rather than their word lists, which are more than twice as large.
    rows = df.drop("corpus")
    joined = with_meta(rows).join(tags, key, "left") if how.costly else with_meta(rows.join(tags, key, "left"))
    joined = joined.withColumn("tag_words", F.coalesce("tag_words", F.array().cast("array<string>")))
    names = [*(name for name in joined.columns if name not in ("tag_words", "meta_words")), "meta_words", "tag_words"]
    return drop_stop_words(joined.select(*names), key, ["tag_words", "meta_words"], stop_words)


def joined_text(df: DataFrame, aliases: Iterable[tuple[str, str]] = ALIASES) -> DataFrame:
    """Both word lists as spaced texts, aliases put back."""
    return df.withColumns(
        {name: join_words(F.col(name), aliases) for name in ("tag_words", "meta_words")}
    )
