"""Word vectors by skip-gram with hierarchical softmax, over texts of any number of words.

Texts become blocks that name each of their words once; blocks are dealt to training tasks, and a
task learns the vectors of the words its share holds and of the inner nodes above them in the
Huffman tree, no others. The tree is never laid out: words of equal frequency are runs of leaves
that are paired as runs, so it is told by a table that grows with the distinct frequencies, and
every task finds its words' paths there. A word's vector is the mean over the tasks that trained it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.operators.segment import longer
from pagesieve.operators.tfidf import row_blocks
from pagesieve.session import small_batches

# Words of a block, words whose neighbours are listed at once, and words trained on together: few
# enough that the gradients of one node, all taken before it moves, stay a small step.
BLOCK_WORDS, LISTED, CENTERS = 1 << 18, 1 << 14, 32
# Words whose paths and first vectors are made at once.
MADE_WORDS = 1 << 14
# A block's number keeps its place in its partition in the lower bits.
PLACE_BITS = 33
# As in Spark ML's Word2Vec: the first learning rate, its least share, and the largest product of
# two vectors that still teaches.
RATE, LEAST_RATE, MOST_PRODUCT = 0.025, 1e-4, 6.0


def token_blocks(texts: DataFrame, words: str) -> DataFrame:
    """``block, n_words, sizes, words, codes``: the texts of a block in one row. ``words`` names
    every distinct word of the block with its occurrences; ``sizes`` are the texts' lengths and
    ``codes`` the places of their words in ``words``, in order, as little-endian integers."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << PLACE_BITS
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            for at, to in row_blocks(np.append(0, np.cumsum(sizes)), BLOCK_WORDS):
                tokens = batch.column(0).slice(at, to - at).flatten()
                coded = tokens.cast(pa.large_string()).dictionary_encode()
                n_words = len(coded.dictionary)
                codes = pc.fill_null(coded.indices, n_words).to_numpy(zero_copy_only=False)  # NULL is no word
                found = np.bincount(codes, minlength=n_words + 1)[:n_words]
                entries = pa.StructArray.from_arrays([coded.dictionary.cast(pa.string()), pa.array(found, pa.int64())], names=["word", "n"])
                columns = [
                    pa.array([block], pa.int64()),
                    pa.array([len(codes)], pa.int64()),
                    pa.array([sizes[at:to].astype("<i4").tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, n_words], pa.int32()), entries),
                    pa.array([codes.astype(code_type(n_words)).tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "n_words", "sizes", "words", "codes"])
                block += 1

    return texts.select(words).mapInArrow(run, "block long, n_words long, sizes binary, words array<struct<word: string, n: long>>, codes binary")


def code_type(n_words: int) -> str:
    return "<u2" if n_words < 1 << 16 else "<u4"


@dataclass
class Tree:
    """A Huffman tree by runs of nodes. Leaves are numbered from 0 by rising frequency, inner nodes
    go on from there; node ``first[i] + k`` is child ``(k + odd[i]) % 2`` of ``above[i] + (k + odd[i]) // 2``."""

    first: np.ndarray
    above: np.ndarray
    odd: np.ndarray
    n_leaves: int

    def paths(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``leaf (its place in leaves), node, child`` for every inner node above every leaf, in
        the order of ``leaves``."""
        at, nodes, found = np.arange(len(leaves)), leaves.astype(np.int64), []
        root = 2 * self.n_leaves - 2
        while len(at := at[on := nodes != root]):
            nodes = nodes[on]
            run = np.searchsorted(self.first, nodes, "right") - 1
            place = nodes - self.first[run] + self.odd[run]
            nodes = self.above[run] + place // 2
            found.append((at, nodes, place & 1))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        leaf, node, child = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.argsort(leaf, kind="stable")
        return leaf[order], node[order], child[order]


def huffman(runs: list[tuple[int, int]]) -> Tree:
    """The tree of ``runs``: frequencies, rising, and how many words have each.

    The lightest nodes pair up; a run of equals pairs up within itself, and its odd one out takes
    the first node of the next run.
    """
    leaves, start = deque(), 0
    for weight, n in runs:
        leaves.append([weight, n, start])
        start += n
    n_leaves, inner, made = start, deque(), []

    def lightest() -> deque:
        return leaves if leaves and (not inner or leaves[0][0] < inner[0][0]) else inner

    while leaves or inner:
        queue = lightest()
        weight, n, first = queue[0]
        if n > 1:
            made.append((first, start, 0))
            pairs = n // 2
            if n % 2:
                queue[0] = [weight, 1, first + n - 1]
            else:
                queue.popleft()
            weight *= 2
        else:
            queue.popleft()
            if not leaves and not inner:
                break  # the root
            queue = lightest()
            other, n, second = queue[0]
            made += [(first, start, 0), (second, start, 1)]
            if n > 1:
                queue[0] = [other, n - 1, second + 1]
            else:
                queue.popleft()
            pairs, weight = 1, weight + other
        inner.append([weight, pairs, start])
        start += pairs
    table = np.array(sorted(made), np.int64).reshape(-1, 3)
    return Tree(*table.T, n_leaves)


def first_vectors(leaves: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Every leaf's vector before training, drawn evenly within half a unit over ``size``."""
    drawn = longer(longer(np.full((len(leaves), 1), seed, np.uint64), leaves.astype(np.uint64)[:, None]), np.arange(size, dtype=np.uint64))
    return (((drawn >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)).astype(np.float32)


class Share:
    """The words of one training task, by their places in ``words``."""

    def __init__(self, words: pa.Array, leaves: np.ndarray, tree: Tree, size: int, window: int, seed: int, share: int, n_shares: int, total: int):
        self.words, self.window, self.n_shares, self.total = words, window, n_shares, total
        parts = [leaves[at : at + MADE_WORDS] for at in range(0, len(leaves), MADE_WORDS)]
        depths, nodes, right = [np.zeros(1, np.int64)], [], []
        for part in parts:
            leaf, node, child = tree.paths(part)
            depths.append(np.bincount(leaf, minlength=len(part)))
            nodes.append(node.astype(np.int32 if tree.n_leaves < 1 << 30 else np.int64))
            right.append((child == 0).astype(np.float32))
        self.begin = np.cumsum(np.concatenate(depths))
        self.nodes, node = np.unique(np.concatenate(nodes), return_inverse=True)
        self.node, self.right = node.astype(np.int32), np.concatenate(right)
        self.vectors = np.concatenate([first_vectors(part, size, seed) for part in parts])
        self.inner = np.zeros((len(self.nodes), size), np.float32)
        self.trained = np.zeros(len(leaves), bool)
        self.random, self.seen = np.random.default_rng([seed, share]), 0

    def train(self, sizes: np.ndarray, words: np.ndarray, longest: int) -> None:
        """Train on texts given by their lengths and the places of their words (-1: none)."""
        text = np.repeat(np.arange(len(sizes)), sizes)[words >= 0]
        words = words[words >= 0]
        n = len(words)
        if not n:
            return
        # A sentence is a text, or its pieces of ``longest`` known words.
        place = np.arange(n)
        starts = np.searchsorted(text, text)
        begin = starts + (place - starts) // longest * longest
        end = np.minimum(begin + longest, np.searchsorted(text, text, "right"))
        reach = self.window - self.random.integers(0, self.window, n)
        for at in range(0, n, LISTED):
            self.train_part(words, begin, end, reach, at, min(n, at + LISTED))
        self.seen += n

    def train_part(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, reach: np.ndarray, first: int, last: int) -> None:
        """Train on the words from ``first`` to before ``last``, each with its neighbours between
        ``begin`` and ``end`` within ``reach``."""
        place = np.arange(first, last)
        offsets = np.array([at for at in range(-self.window, self.window + 1) if at])
        near = place[:, None] + offsets
        pair = (np.abs(offsets) <= reach[place, None]) & (near >= begin[place, None]) & (near < end[place, None])
        center, context = np.repeat(place - first, pair.sum(axis=1)), words[near[pair]]
        # The inner nodes above every center, one after the other.
        own = words[first:last]
        depth = self.begin[own + 1] - self.begin[own]
        ends = np.cumsum(depth)
        path = np.repeat(self.begin[own] - ends + depth, depth) + np.arange(ends[-1])
        above, node, right = np.repeat(place - first, depth), self.node[path], self.right[path]
        n_batches = -(-len(own) // CENTERS)
        held, held_at, held_ends = distinct(center // CENTERS, context, n_batches, len(self.vectors))
        nodes, node_at, node_ends = distinct(above // CENTERS, node, n_batches, max(1, len(self.nodes)))
        pair_ends, path_ends = (np.searchsorted(of, np.arange(n_batches + 1) * CENTERS) for of in (center, above))
        for at in range(n_batches):
            pairs, paths = slice(*pair_ends[at : at + 2]), slice(*path_ends[at : at + 2])
            self.step(
                held[slice(*held_ends[at : at + 2])], held_at[pairs], center[pairs] - at * CENTERS,
                nodes[slice(*node_ends[at : at + 2])], node_at[paths], above[paths] - at * CENTERS, right[paths],
                np.float32(RATE * max(LEAST_RATE, 1 - self.n_shares * (self.seen + first + at * CENTERS) / self.total)),
            )

    def step(self, held, held_at, center, nodes, node_at, above, right, rate) -> None:
        """One step over some centers: ``center`` has the word ``held[held_at]`` near it; ``above``
        has the nodes ``nodes[node_at]`` above it, and goes ``right`` there or not."""
        if not len(held) or not len(nodes):
            return
        near = np.bincount(center * len(held) + held_at, minlength=CENTERS * len(held)).reshape(CENTERS, len(held)).astype(np.float32)
        goes = np.zeros((2, CENTERS, len(nodes)), np.float32)
        goes[0, above, node_at] = right
        goes[1, above, node_at] = 1
        wanted, met = near.T @ goes[0], near.T @ goes[1]
        vectors, inner = self.vectors.take(held, axis=0), self.inner.take(nodes, axis=0)
        product = vectors @ inner.T
        teaches = np.abs(product) < MOST_PRODUCT
        product *= teaches  # others count for nothing below
        np.negative(product, out=product)
        np.exp(product, out=product)
        product += 1
        met *= teaches
        wanted *= teaches
        wanted -= met / product
        # A row moves by the sum of its slopes over what bounds their change along that sum, so
        # that meeting the same words many times in one step leads towards what they ask for and
        # not past it: a slope changes by a quarter of a product's at most.
        met *= rate / 4
        vectors_by = 1 + met @ np.einsum("ij,ij->i", inner, inner)
        inner_by = 1 + np.einsum("ij,ij->i", vectors, vectors) @ met
        wanted *= rate
        self.vectors[held] = vectors + (wanted @ inner) / vectors_by[:, None]
        self.inner[nodes] = inner + (wanted.T @ vectors) / inner_by[:, None]
        self.trained[held] = True


def distinct(batch: np.ndarray, item: np.ndarray, n_batches: int, n_items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct items of every batch one after the other, each entry's place among those of its
    batch, and where the batches begin and end."""
    keys, at = np.unique(batch * n_items + item, return_inverse=True)
    ends = np.searchsorted(keys, np.arange(n_batches + 1) * n_items)
    return keys % n_items, at - ends[batch], ends


def train_shares(
    blocks: DataFrame, index: DataFrame, n_shares: int, size: int, window: int, seed: int, longest: int
) -> DataFrame:
    """``word, share, trained, vector``: what each of ``n_shares`` tasks learns of its words.

    ``blocks`` are those of ``token_blocks``; ``index`` has ``word, id, freq`` of the words to
    learn, ids from 1 by falling frequency. Vectors are bytes of little-endian floats.
    """
    runs = [tuple(row) for row in index.groupBy("freq").agg(F.count("*")).orderBy("freq").collect()]
    total, n_leaves = sum(freq * n for freq, n in runs), sum(n for _, n in runs)
    tree = blocks.sparkSession.sparkContext.broadcast(huffman(runs))

    place = F.col("block").bitwiseAND((1 << PLACE_BITS) - 1)
    dealt = blocks.withColumn("share", F.pmod(F.shiftright("block", PLACE_BITS) + place, n_shares).cast("int"))
    # A share's words come before its blocks, each once, whatever number of blocks holds it.
    own = dealt.select("share", F.explode("words.word").alias("word")).distinct().join(index, "word")
    nothing = {name: F.lit(None).cast(kind) for name, kind in (("words", "array<string>"), ("sizes", "binary"), ("codes", "binary"))}
    own = own.select("share", F.lit(-1).cast("long").alias("block"), "word", (n_leaves - F.col("id")).alias("leaf")).withColumns(nothing)
    rows = dealt.select(
        "share", "block", F.lit(None).cast("string").alias("word"), F.lit(None).cast("long").alias("leaf"),
        F.col("words.word").alias("words"), "sizes", "codes",
    )
    rows = own.unionByName(rows).repartitionById(n_shares, "share").sortWithinPartitions("share", "block", "leaf")
    small_batches(blocks.sparkSession)

    def learned(share: Share | None, number: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(share.words) if share else 0, 10_000):
            vectors = share.vectors[at : at + 10_000].astype("<f4")
            columns = [
                share.words.slice(at, 10_000).cast(pa.string()),
                pa.array(np.full(len(vectors), number), pa.int32()),
                pa.array(share.trained[at : at + 10_000]),
                pa.array([row.tobytes() for row in vectors], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "share", "trained", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, share, words, leaves = None, None, [], []
        for batch in batches:
            for row in range(batch.num_rows):
                if (of := batch.column(0)[row].as_py()) != number:
                    yield from learned(share, number)
                    number, share, words, leaves = of, None, [], []
                if batch.column(1)[row].as_py() < 0:
                    words.append(batch.column(2)[row].as_py())
                    leaves.append(batch.column(3)[row].as_py())
                    continue
                if share is None and words:
                    share = Share(pa.array(words, pa.large_string()), np.array(leaves), tree.value, size, window, seed, number, n_shares, total)
                    words, leaves = [], []
                if share is not None:
                    named = batch.column(4)[row].values.cast(pa.large_string())
                    places = pc.fill_null(pc.index_in(named, value_set=share.words), -1).to_numpy(zero_copy_only=False)
                    sizes, codes = (batch.column(at)[row].as_buffer() for at in (5, 6))
                    codes = np.frombuffer(codes, code_type(len(named)))
                    share.train(np.frombuffer(sizes, "<i4"), np.append(places, -1)[codes], longest)
        yield from learned(share, number)

    return rows.mapInArrow(run, "word string, share int, trained boolean, vector binary")


def averaged(learned: DataFrame, size: int) -> DataFrame:
    """``word, vector`` (floats): the mean of a word's vectors over the shares that trained it; of
    one that none did, the vector it began with."""

    def mean_of(kept: list[tuple[bool, bytes]]) -> np.ndarray:
        chosen = [vector for trained, vector in kept if trained] or [kept[0][1]]
        return np.mean([np.frombuffer(vector, "<f4") for vector in chosen], axis=0, dtype=np.float64).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, kept = None, []
        for batch in batches:
            words, means = [], []
            for of, trained, vector in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if kept and of != word:
                    words.append(word)
                    means.append(mean_of(kept))
                    kept = []
                word = of
                kept.append((trained, vector))
            if words:
                yield rows_of(words, means)
        if kept:
            yield rows_of([word], [mean_of(kept)])

    def rows_of(words: list[str], means: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.arange(len(words) + 1) * size, pa.int32())
        vectors = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(means), pa.float32()))
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), vectors], names=["word", "vector"])

    together = learned.repartition("word").sortWithinPartitions("word", "share")
    return together.select("word", "trained", "vector").mapInArrow(run, "word string, vector array<float>")
