"""Periodic runs of words, by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
and length at least ``max(min_length, exponent * q)``, that no neighbouring word extends with
period ``q``. For every word, each earlier occurrence at lag ``d`` continues the match length of
diagonal ``d`` by one; a diagonal that stops matching ends a maximal stretch of period ``d``, which
is emitted at once when long enough. Only cells where a word equals an earlier one exist, so the
table is sparse.

Two exact reductions keep the cells few. A run of period ``d`` holds at least ``exponent * d``
words, so lags above ``n / exponent`` never matter. And every run's diagonal matches at least
three words in a row (``max(6 - d, 3 d) >= 3``), so the cells are taken over word trigrams rather
than words: a diagonal of trigrams ``s..t`` is exactly a diagonal of words ``s..t+2``, maximal at
both ends. The cells of one trigram are its occurrences paired in position order; they are made
a lag step at a time for all trigrams at once, and the diagonals read off by sorting cells by lag
and position. A stretch whose smallest period is ``p < d`` is, for long stretches (Fine and Wilf),
also emitted with ``p`` over the same words, so of stretches with the same ends the smallest
period stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import mapped

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]


def runs_of(ids: np.ndarray, min_length: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in the integer sequence ``ids``, by start, then
    period. Empty or short sequences have none."""
    n = len(ids)
    most_lag = n // exponent
    if n < max(min_length, 3) or most_lag < 1:
        return []
    ids = np.asarray(ids, dtype=np.int64)
    width = int(ids.max()) + 1
    _, pairs = np.unique(ids[:-1] * width + ids[1:], return_inverse=True)
    _, trigrams = np.unique(pairs[:-1].astype(np.int64) * width + ids[2:], return_inverse=True)
    m = n - 2
    at = np.argsort(trigrams, kind="stable")
    key = trigrams[at]
    later, lags = [], []
    alive, step = np.arange(m - 1), 1
    while alive.size:
        alive = alive[alive + step < m]
        lag = at[alive + step] - at[alive]
        fits = (key[alive] == key[alive + step]) & (lag <= most_lag)
        alive = alive[fits]
        later.append(at[alive + step])
        lags.append(lag[fits])
        step += 1
    cell_at, cell_lag = np.concatenate(later), np.concatenate(lags)
    if cell_at.size == 0:
        return []
    order = np.lexsort((cell_at, cell_lag))
    cell_at, cell_lag = cell_at[order], cell_lag[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(cell_lag) != 0) | (np.diff(cell_at) != 1)])
    ends = np.r_[starts[1:], cell_at.size] - 1
    period = cell_lag[starts]
    first = cell_at[starts] - period
    length = cell_at[ends] + 2 - first + 1
    long_enough = length >= np.maximum(min_length, exponent * period)
    first, length, period = first[long_enough], length[long_enough], period[long_enough]
    if first.size == 0:
        return []
    # Of stretches with the same ends the smallest period is theirs.
    order = np.lexsort((period, length, first))
    first, length, period = first[order], length[order], period[order]
    new = np.r_[True, (np.diff(first) != 0) | (np.diff(length) != 0)]
    found = zip(first[new].tolist(), length[new].tolist(), period[new].tolist())
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: Sequence[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    cut = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        cut[start + period] += 1
        cut[start + length] -= 1
    dropped = np.cumsum(cut[:-1]) > 0
    return " ".join(word for word, gone in zip(words, dropped.tolist()) if not gone)


def find_runs(df: DataFrame, words: str, keep: Sequence[str], min_length: int = 6, exponent: int = 4) -> DataFrame:
    """``keep`` and, for the array of strings ``words``, ``runs`` (start, length, period, by start
    then period) and ``collapsed`` (the words no run holds after its first period, joined by one
    space).

    A null or empty array has no runs and collapses to ``''``; null words are words like any
    other, equal to each other. Rows stay where they are; any number of repeated rows or keys is
    handled row by row. A kept column named ``runs`` or ``collapsed`` is replaced. Cells per
    document are pairs of equal word trigrams at most ``n / exponent`` apart: few in prose, up to
    ``n**2 / exponent`` when one word fills the text, and they are made one lag step at a time.
    """

    def make():
        def work(values: pa.Array) -> list[pa.Array]:
            found, texts = [], []
            # One row's words at a time: a batch of long texts as Python strings at once is large.
            for item in values:
                sequence = item.as_py() or []
                names: dict = {}
                ids = np.fromiter((names.setdefault(word, len(names)) for word in sequence), np.int64, len(sequence))
                runs = runs_of(ids, min_length, exponent)
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                texts.append(collapsed(["" if word is None else word for word in sequence], runs))
            return [pa.array(found, pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))), pa.array(texts, pa.string())]

        return work

    return mapped(df, words, keep, FIELDS, make)


def words_of(text: Column) -> Column:
    """Runs of characters other than blanks (space, tab, line feed, vertical tab, form feed,
    carriage return); null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1), F.array().cast("array<string>"))


def sha256_hex(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()
