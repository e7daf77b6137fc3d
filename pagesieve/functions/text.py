"""Text columns: character filters, aliases, word lists. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kept character range, the alias pairs, the padding word.
HAN = "一-龥"
ALIASES = (("p2p", "个贷"),)
PAD_WORD = "</s>"

LETTERS = r"\p{L}"


def keep_characters(text: Column, keep: str = HAN) -> Column:
    """Remove every character outside the class ``keep``."""
    return F.regexp_replace(text, f"[^{keep}]", "")


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replace_aliases(text: Column, pairs: Iterable[tuple[str, str]] = ALIASES) -> Column:
    """Put each term's alias in its place, whatever the term's case."""
    for term, alias in pairs:
        text = F.regexp_replace(text, f"(?i){re.escape(term)}", _literal(alias))
    return text


def restore_aliases(text: Column, pairs: Iterable[tuple[str, str]] = ALIASES) -> Column:
    """Put the terms back, inside longer words too."""
    for term, alias in pairs:
        text = F.regexp_replace(text, f"(?i){re.escape(alias)}", _literal(term))
    return text


def concat_meta(title: Column, keywords: Column, description: Column) -> Column:
    """The three meta fields in one text; NULL if any of them is."""
    return F.concat(title, keywords, description)


def merge_meta(title: Column, keywords: Column, description: Column, missing: str = "nan") -> Column:
    """As ``concat_meta``, but only a missing title gives NULL."""
    return F.concat(
        title, F.coalesce(keywords, F.lit(missing)), F.coalesce(description, F.lit(missing))
    )


def letter_words(text: Column, min_length: int = 2) -> Column:
    """Lower-case words of alphabetic text; shorter ones are left out."""
    words = F.split(F.lower(text), r"[^\p{L}]+")
    return F.filter(words, lambda word: F.length(word) >= min_length)


def split_words(text: Column) -> Column:
    """Split a joined word list on white space, skipping empty parts."""
    return F.filter(F.split(text, r"[\s\p{Z}]+"), lambda word: word != "")


def join_words(words: Column, aliases: Iterable[tuple[str, str]] = ()) -> Column:
    """The word list as one spaced text, with its aliases put back."""
    return restore_aliases(F.array_join(words, " "), aliases)


def fixed_length(items: Column, length: int, pad: Column) -> Column:
    """Exactly ``length`` items: cut on the right, or padded there."""
    return F.slice(F.concat(items, F.array_repeat(pad, length)), 1, length)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and name it in ``body``.

    An expression used inside another lambda would otherwise be computed for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(words: Column, size: int) -> Column:
    """The runs of ``size`` neighbouring words, in order."""

    def runs(bound: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(bound) - (size - 1))
        found = F.transform(starts, lambda start: F.array_join(F.slice(bound, start, size), " "))
        return F.when(F.size(bound) >= size, found).otherwise(F.array().cast("array<string>"))

    return let(words, runs)


def word_counts(words: Column) -> Column:
    """``array<struct<word, tf>>`` of one word list, counted inside the row.

    The list is sorted once and each run of equal words measured from where it and the next run
    start, so a text needs neither a shuffle nor a quadratic scan.
    """

    def run_starts(ordered: Column) -> Column:
        new_run = lambda word, at: F.when((at == 0) | (F.get(ordered, at - 1) != word), at)
        return F.array_compact(F.transform(ordered, new_run))

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, at: F.struct(
                F.get(ordered, start).alias("word"),
                (F.coalesce(F.get(starts, at + 1), F.size(ordered)) - start)
                .cast("long")
                .alias("tf"),
            ),
        )

    return let(
        F.sort_array(words),
        lambda ordered: let(run_starts(ordered), lambda starts: runs(ordered, starts)),
    )


def without(words: Column, dropped: Column) -> Column:
    """``words`` in order, without those in the array ``dropped``.

    The intersection is hashed, so only the few dropped words the row really holds are compared
    one by one.
    """
    return let(
        words,
        lambda bound: let(
            F.array_intersect(bound, dropped),
            lambda present: F.filter(bound, lambda word: ~F.array_contains(present, word)),
        ),
    )


def parse_ints(text: Column) -> Column:
    """The integers of a comma-separated list such as ``1,2,3``."""
    return F.transform(F.split(text, ","), lambda part: F.trim(part).cast("int"))
