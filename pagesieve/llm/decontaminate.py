"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Text and items are cut into words alike: A-Z lower-cased, ASCII letters and digits and all
other characters beyond ASCII form words, every other ASCII character separates. Normalising
changes single bytes only, so a word's place in the normalised text is its place in the original.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import as_bytes, filtered, small_batches

WINDOW = 10
#: Windows in one automaton: it takes about 3 KB each. More are scanned for block by block.
BLOCK_WINDOWS = 20_000
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")

FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> Iterator[bytes]:
    """Runs of ``window`` words; all the words where they are fewer, nothing where there are none."""
    for at in range(max(1, len(words) - window + 1) if words else 0):
        yield b" ".join(words[at : at + window])


def window_blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_WINDOWS) -> Iterator[list[tuple[bytes, str]]]:
    """The pairs of window and item, in blocks of about ``size`` that can be sent to the tasks."""
    pairs_of = T.StructType([T.StructField("words", T.BinaryType()), T.StructField("item", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text")), strict=True):
                found = list(set(windows_of(words_of(text), window)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([item] * len(found), pa.string())], pairs_of.names)

    small_batches(benchmark.sparkSession)
    # Items without id still hit words; only their name is missing from the items found.
    pairs = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(cut, pairs_of)
    blocks = max(1, math.ceil(pairs.count() / size))
    for block in range(blocks):
        yield [tuple(row) for row in pairs.where(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == block).collect()]


class Automaton:
    """All windows of a block in one automaton. Words are closed by blanks on both sides, so a
    window never begins or ends inside a word; bytes are scanned as Latin-1 characters."""

    def __init__(self, pairs: Iterable[tuple[bytes, str]]) -> None:
        import ahocorasick

        items: dict[bytes, list[str]] = {}
        for words, item in pairs:
            items.setdefault(bytes(words), []).append(item)
        self.tree = ahocorasick.Automaton()
        for words, of in items.items():
            self.tree.add_word(f" {words.decode('latin-1')} ", (words.count(b" ") + 1, of))
        if items:
            self.tree.make_automaton()
        self.empty = not items

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit, None for none, and the items that hit them."""
        if self.empty or not words:
            return None, set()
        line = f" {b' '.join(words).decode('latin-1')} "
        ends: np.ndarray | None = None
        change, items = None, set()
        for end, (count, of) in self.tree.iter(line):
            if change is None:
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                change = np.zeros(len(words) + 1, np.int64)
            last = int(np.searchsorted(ends, end)) + 1
            change[last - count] += 1
            change[last] -= 1
            items.update(item for item in of if item is not None)
        return (None if change is None else np.cumsum(change[:-1]) > 0), items

    def meets(self, words: list[bytes]) -> bool:
        return not self.empty and bool(words) and next(self.tree.iter(f" {b' '.join(words).decode('latin-1')} "), None) is not None


def original_spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Where runs of hit words lie in the original text, in characters."""
    places = [match.span() for match in WORD.finditer(text.translate(WORD_BYTES))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(before[places[a][0]]), "end": int(before[places[b - 1][1]])} for a, b in edges.reshape(-1, 2)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``key, n_words, n_hit, items, spans`` for every row of ``docs`` (``key, text``).

    A window is ``window`` consecutive words of a ``benchmark`` item (``item_id, text``), or all
    of an item's words if it has fewer. A word of a text is hit when it lies in an occurrence of
    a window; ``items`` are the ids of those that occur, as sorted strings, ``spans`` the
    hit runs in characters of the original. Null and empty texts have no words; items without
    words never occur; items without id hit words like others, but have no id to list.
    Repeated rows are judged each; an empty benchmark hits nothing.

    The text is scanned once for each block of ``block`` windows, in place and without a shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    state = [T.StructField("hit", T.BinaryType()), T.StructField("found", T.ArrayType(T.StringType()))]
    rows = docs.select(key, F.col("text").cast("string").alias("text")).withColumns({"hit": F.lit(None).cast("binary"), "found": F.array().cast("array<string>")})
    blocks = list(_sent(spark, window_blocks(benchmark, window, block)))
    for pairs in blocks[:-1]:
        rows = rows.mapInArrow(_scanner(pairs, final=False), T.StructType([rows.schema[key], rows.schema["text"], *state]))
    return rows.mapInArrow(_scanner(blocks[-1], final=True), T.StructType([rows.schema[key], *FOUND]))


def _sent(spark: SparkSession, blocks: Iterable[list]) -> Iterator:
    """A block is bounded by its size, so it may go to every task."""
    return (spark.sparkContext.broadcast(pairs) for pairs in blocks)


def _scanner(pairs, final: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Automaton(pairs.value)
        for batch in batches:
            bits, found, counts, n_hit, spans = [], [], [], [], []
            columns = (as_bytes(batch.column("text")), batch.column("hit").to_pylist(), batch.column("found").to_pylist())
            for text, earlier, items in zip(*columns, strict=True):
                words = words_of(text)
                hit, met = tree.scan(words)
                if earlier is not None:
                    old = np.unpackbits(np.frombuffer(earlier, np.uint8), count=len(words)).astype(bool)
                    hit = old if hit is None else hit | old
                found.append(sorted(met.union(items)))
                bits.append(None if hit is None else np.packbits(hit).tobytes())
                counts.append(len(words))
                n_hit.append(0 if hit is None else int(hit.sum()))
                if final:
                    spans.append([] if hit is None else original_spans(text, hit))
            found_column = pa.array(found, pa.list_(pa.string()))
            if final:
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), found_column, pa.array(spans, span)]
                yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[0], *(field.name for field in FOUND)])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary()), found_column], ["key", "text", "hit", "found"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of ``benchmark``, with all their columns."""
    for pairs in _sent(docs.sparkSession, window_blocks(benchmark, window, block)):

        def make(pairs=pairs):
            tree = Automaton(pairs.value)
            return lambda texts: pa.array([not tree.meets(words_of(text)) for text in as_bytes(texts)], pa.bool_())

        docs = filtered(docs, "text", make)
    return docs
