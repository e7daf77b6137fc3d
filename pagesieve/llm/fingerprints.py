"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases where labels from deterministic coin tossing peak; phrases
get names by their content, and the names are parsed again, level by level, up to one name for
the whole text. Where a cut falls depends on a few neighbours only, so equal substrings are cut
into the same phrases, but for their edges, wherever they stand. A fingerprint holds the root's
name and the lowest hashes among the names of the phrases of a few words and more; the share of
equal ones estimates how much of two texts is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import as_bytes, shuffle_partitions, small_batches
from pagesieve.session import stored

#: Hashes in a fingerprint; first level whose names count (a level's phrases hold about three of
#: the level below); bytes parsed together.
KEPT, LEVEL, BLOCK = 64, 2, 1 << 20
ROUNDS = 3
A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


def tossing_table(values: int) -> np.ndarray:
    """For a label and its left neighbour's: twice the lowest bit in which they differ, plus that
    bit of the label. Neighbours that differ get labels that differ."""
    label, left = np.meshgrid(np.arange(values), np.arange(values), indexing="ij")
    differ = label ^ left
    bit = np.zeros_like(label)
    for at in range(values.bit_length() - 1, -1, -1):
        bit[(differ >> at) & 1 == 1] = at
    return (2 * bit + ((label >> bit) & 1)).astype(np.uint8)


TABLE = tossing_table(128).ravel()


def labels_of(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 whose neighbours differ; ``first`` are the places where a text begins."""
    if names.dtype == np.uint8:
        left = np.empty_like(names)
        left[1:] = names[:-1]
        left[first] = names[first] ^ np.uint8(1)
        differ = names ^ left
        bit = LOWEST[differ]
        labels = 2 * bit + ((names >> bit) & np.uint8(1))
    else:
        left = np.empty_like(names)
        left[1:] = names[:-1]
        left[first] = names[first] ^ np.uint64(1)
        differ = names ^ left
        bit = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
        labels = (2 * bit + ((names >> bit.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(ROUNDS):
        pair = labels.astype(np.uint16) << np.uint16(7)
        pair[1:] |= labels[:-1]
        pair[first] = (pair[first] & np.uint16(127 << 7)) | (labels[first] ^ np.uint8(1))
        labels = TABLE[pair]
    return labels


LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)


def runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal neighbours of one text taken together: names of the runs, their places, their lengths."""
    new = np.empty(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[first] = True
    at = np.flatnonzero(new)
    return names[at], at, np.diff(np.append(at, len(names)))


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the names of the phrases, and where each text's begin among them."""
    wide, at, lengths = runs(names, first)
    first = np.searchsorted(at, first)
    # A run is one symbol: its name and, where it is longer than one, its length.
    symbols = mixed(wide.astype(np.uint64) * A + lengths.astype(np.uint64))
    labels = labels_of(wide if wide.dtype == np.uint8 else symbols, first)
    peak = np.zeros(len(labels), bool)
    if len(labels) > 2:
        peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The ends of a text see nothing beyond: no phrase begins at its last symbol, one does at its first.
    peak[first[1:] - 1] = False
    peak[first] = False
    after = first + 1
    ends = np.append(first[1:], len(labels))
    peak[after[after < ends]] = False
    peak[first] = True
    begin = np.flatnonzero(peak)
    sizes = np.diff(np.append(begin, len(labels)))
    place = np.arange(len(labels)) - np.repeat(begin, sizes)
    total = np.add.reduceat(mixed(symbols + place.astype(np.uint64) * B), begin)
    return mixed(total + sizes.astype(np.uint64) * C), np.searchsorted(begin, first)


def sketches(texts: Sequence[bytes]) -> list[tuple[int, np.ndarray]]:
    """Root name and sorted lowest hashes of every text; (0, empty) for an empty one."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    which = np.flatnonzero(sizes)
    roots = np.zeros(len(texts), np.uint64)
    out = [np.empty(0, np.uint32)] * len(texts)
    if not len(which):
        return [(0, x) for x in out]
    names = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes[which])[:-1]])
    level, kept = 0, []
    while len(which):
        names, first = parse(names, first)
        level += 1
        counts = np.diff(np.append(first, len(names)))
        done = counts == 1
        roots[which[done]] = names[first[done]]
        if level >= LEVEL or done.any():
            use = np.repeat(done | (level >= LEVEL), counts)
            low = mixed(names[use] + np.uint64(level >= LEVEL) * A) >> np.uint64(32)
            kept.append((np.repeat(which, counts)[use].astype(np.uint64) << np.uint64(32)) | low)
        stay = np.repeat(~done, counts)
        names, which, counts = names[stay], which[~done], counts[~done]
        first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(which) else np.empty(0, np.int64)
    every = np.unique(np.concatenate(kept))
    owner = every >> np.uint64(32)
    begin = np.searchsorted(owner, np.arange(len(texts) + 1, dtype=np.uint64))
    low = (every & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [(int(roots[at]), low[begin[at] : min(begin[at + 1], begin[at] + KEPT)]) for at in range(len(texts))]


def packed(sketch: tuple[int, np.ndarray]) -> bytes:
    return sketch[0].to_bytes(8, "big") + sketch[1].astype(">u4").tobytes()


def likeness(left: bytes, right: bytes) -> float:
    """Estimated share of common names, 0 to 1: 1 for equal fingerprints, 0 if just one is of an
    empty text."""
    if left == right:
        return 1.0
    a, b = (np.frombuffer(x, ">u4", offset=8) for x in (left, right))
    both = np.union1d(a, b)[:KEPT]
    if not len(both):
        return 0.0
    return float(len(np.intersect1d(np.intersect1d(a, b), both)) / len(both))


def blocks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Texts by about ``BLOCK`` bytes; a longer one alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > BLOCK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def fingerprint_texts(texts: Sequence[bytes]) -> list[bytes]:
    return [packed(sketch) for block in blocks(iter(texts)) for sketch in sketches(block)]


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first characters of ``following``, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def judged(texts: list[bytes], prints: list[bytes]) -> tuple[list, ...]:
    """For every text but the last: characters, digest of its edited text, both fingerprints and
    the likenesses, the text behind it being the next."""
    plain = [text.decode("utf-8", "replace") for text in texts]
    after = [edited(a, b).encode() for a, b in zip(plain[:-1], plain[1:], strict=True)]
    others = fingerprint_texts(after)
    return (
        [len(x) for x in plain[:-1]],
        [hashlib.sha256(x).hexdigest() for x in after],
        prints[:-1],
        others,
        [likeness(a, b) for a, b in zip(prints, others, strict=False)],
        [likeness(a, b) for a, b in zip(prints[:-1], prints[1:], strict=True)],
    )


JUDGED = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.BinaryType()),
    T.StructField("edited_fingerprint", T.BinaryType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]
JUDGED_TYPES = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())


def with_fingerprints(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all but ``text``) and ``fingerprint``, of every row. Null counts as
    empty. Equal texts have equal fingerprints; rows stay where they are."""
    from pagesieve.llm.common import mapped

    def make():
        return lambda texts: [pa.array(fingerprint_texts([x or b"" for x in as_bytes(texts)]), pa.binary())]

    return mapped(docs, text, [c for c in docs.columns if c != text] if keep is None else keep, [T.StructField("fingerprint", T.BinaryType())], make)


def compare_neighbours(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is that with the next lower key, rows of one key in the order of their
    texts, and after the last comes the first; a single row is its own next. The edited text has
    its last third of characters (rounded down) replaced by as many first ones of the next, or
    all of them. Null texts count as empty; other columns are not read; no rows give none.

    Rows are sorted into ranges of keys and compared inside them in one pass. Only the last row
    of each range waits for the first of the following one: those, one pair per range, are
    matched in a second small step from the stored result of the pass.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType
    # Role 0: finished. 1: first of its range, 2: last of its range, both with their text.
    swept = T.StructType([T.StructField("role", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("key", kind), T.StructField("text", T.BinaryType()), *JUDGED])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def ends(role: int, key_column: pa.Array, text: bytes, fingerprint: bytes) -> pa.RecordBatch:
            rest = [pa.array([x], t) for x, t in zip((None, None, fingerprint, None, None, None), JUDGED_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([role], pa.int32()), pa.array([part], pa.int32()), key_column, pa.array([text], pa.binary()), *rest], swept.names)

        held = None
        for batch in batches:
            start = 0
            every = [x or b"" for x in as_bytes(batch.column("text"))]
            for texts in blocks(iter(every)):
                keys = batch.column("key").slice(start, len(texts))
                start += len(texts)
                prints = fingerprint_texts(texts)
                if held is None:
                    yield ends(1, keys.slice(0, 1), texts[0], prints[0])
                else:
                    keys = pa.concat_arrays([held[0], keys])
                    texts, prints = [held[1], *texts], [held[2], *prints]
                if len(texts) > 1:
                    count = len(texts) - 1
                    made = [pa.array(x, t) for x, t in zip(judged(texts, prints), JUDGED_TYPES, strict=True)]
                    fixed = [pa.array([0] * count, pa.int32()), pa.array([part] * count, pa.int32()), keys.slice(0, count), pa.nulls(count, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*fixed, *made], swept.names)
                held = (keys.slice(len(texts) - 1, 1), texts[-1], prints[-1])
        if held is not None:
            yield ends(2, *held)

    rows = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    # Ranges by key and text, in the order of the sweep: rows that share a key, or have none, are
    # cut between ranges by their texts rather than all falling into one.
    ordered = rows.repartitionByRange(shuffle_partitions(spark), F.desc("key"), "text").sortWithinPartitions(F.desc("key"), "text")
    done = stored(ordered.mapInArrow(sweep, swept), "neighbours")
    columns = [field.name for field in JUDGED]
    inner = done.where("role = 0").select("key", *columns)

    # One row for each end of a range: their number is that of the ranges.
    firsts = done.where("role = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    parts = firsts.select("next_part")
    ring = Window.partitionBy(F.lit(0)).orderBy("next_part")
    follows = parts.select(
        F.col("next_part").alias("part"),
        F.coalesce(F.lead("next_part").over(ring), F.min("next_part").over(Window.partitionBy(F.lit(0)))).alias("next_part"),
    )
    lasts = done.where("role = 2").select("key", "part", "text", "fingerprint").join(follows, "part").join(firsts, "next_part")
    paired = T.StructType([T.StructField("key", kind), *JUDGED])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("text", "next_text", "fingerprint", "next_print"))
            found = [judged([a, b], [p, q]) for a, b, p, q in zip(*columns, strict=True)]
            made = [pa.array([row[at][0] for row in found], t) for at, t in enumerate(JUDGED_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *made], paired.names)

    outer = lasts.select("key", "text", "next_text", "fingerprint", "next_print").mapInArrow(pair, paired)
    return inner.unionByName(outer).withColumnRenamed("key", key)
