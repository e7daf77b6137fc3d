"""Page features and how rows get them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.functions.html import META_RULES, AttrRule, page_fields
from pagesieve.functions.text import ALIASES, HAN, keep_characters, replace_aliases
from pagesieve.operators.skew import skew_join


def page_features(
    snapshots: DataFrame,
    rules: Mapping[str, AttrRule] = META_RULES,
    keep: str = HAN,
    aliases: Iterable[tuple[str, str]] = ALIASES,
    html: str = "html",
) -> DataFrame:
    """Replace the HTML by title, the fields of ``rules`` and the kept characters.

    All fields come from one parse. The body text is taken from the whole source, markup included;
    aliases go in first, or their terms would be lost with the other characters.
    """
    fields = [F.col(f"fields.{name}").alias(name) for name in ("title", *rules)]
    others = [name for name in snapshots.columns if name != html]
    return snapshots.select(
        *others,
        page_fields(F.col(html), rules).alias("fields"),
        keep_characters(replace_aliases(F.col(html), aliases), keep).alias("corpus"),
    ).select(*others, *fields, "corpus")


def join_features(rows: DataFrame, features: DataFrame, unique_key: str) -> DataFrame:
    """Every row with the features of its ``file_path``; NULLs where there are none.

    A path many rows share is split over tasks by ``unique_key``. Rows and features sharing a path
    multiply, as in any join.
    """
    return skew_join(rows, features, "file_path", spread=[F.col(unique_key)])
