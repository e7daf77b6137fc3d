"""Quality classifier: random-indexing vectors pooled per document, a two-layer network, a temperature.

Every whitespace-separated token counts as two words, its letters in lower case and its shape
(upper, lower, digits, other signs, repeats taken together). A word's vector is the sum of the
sparse random index vectors of the words around it; a document's are the means over its letters
and its shapes. A small network on those, trained with weights that restore the labels' share,
gives a logit; a temperature fitted on rows held back from training makes it a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import LOWER, as_bytes, drawn, filtered, mapped, small_batches
from pagesieve.session import stored

#: Labelled texts learned from per label, taken whole: the bound of the sample.
SAMPLE_TEXTS = 3000
#: Most words and shapes with vectors, and in how many texts of the sample one must occur.
MOST_WORDS, MOST_SHAPES, LEAST = 30_000, 4_000, 3
#: Length of a vector, its places that are not 0, words to either side.
SIZE, NONZERO, AROUND = 64, 6, 2
#: Hidden units, passes, rows of a step, step size, decay; every which row is held back for the temperature.
HIDDEN, EPOCHS, STEP_ROWS, RATE, DECAY, HELD = 32, 60, 128, 2e-3, 1e-3, 5
#: Least probability that counts as label 1.
THRESHOLD = 0.3
#: Tokens a task remembers.
REMEMBERED = 200_000

SHAPES = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c for c in range(256))
LETTERS = bytes(c for c in range(128) if not (65 <= c <= 90 or 97 <= c <= 122))
AGAIN = re.compile(rb"(.)\1+", re.S)

FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def word_and_shape(token: bytes) -> tuple[bytes, bytes]:
    return token.translate(LOWER, LETTERS), AGAIN.sub(rb"\1", token.translate(SHAPES))[:12]


def index_places(names: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors of ``names``, drawn from a hash of each name."""
    seeds = np.fromiter((xxhash.xxh3_64_intdigest(name) for name in names), np.uint64, len(names))
    out = np.empty((len(names), NONZERO), np.uint64)
    for at in range(NONZERO):
        seeds = (seeds ^ (seeds >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(at + 1)
        out[:, at] = seeds >> np.uint64(32)
    return (out % np.uint64(SIZE)).astype(np.int64), np.where(out & np.uint64(1 << 20), 1.0, -1.0)


@dataclass
class Vectors:
    """Row of every known word and shape, and their vectors; row 0 of either stands for the rest."""

    words: dict[bytes, int]
    shapes: dict[bytes, int]
    word_vectors: np.ndarray
    shape_vectors: np.ndarray

    def reader(self) -> Rows:
        return Rows(self.words, self.shapes)


class Rows(dict):
    """Token to its word's and shape's rows in one number, remembered up to a bound."""

    def __init__(self, words: dict[bytes, int], shapes: dict[bytes, int]) -> None:
        super().__init__()
        self.words, self.shapes = words, shapes

    def __missing__(self, token: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        word, shape = word_and_shape(token)
        self[token] = value = self.words.get(word, 0) << 16 | self.shapes.get(shape, 0)
        return value

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = (text or b"").split()
        both = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return both >> 16, both & 0xFFFF


def token_counts(texts: Sequence[bytes]) -> tuple[Counter, Counter]:
    """In how many of ``texts`` each word and each shape occurs."""
    words, shapes = Counter(), Counter()
    for text in texts:
        both = [word_and_shape(token) for token in set((text or b"").split())]
        words.update({word for word, _ in both})
        shapes.update({shape for _, shape in both})
    return words, shapes


def numbered(counts: Counter, most: int) -> dict[bytes, int]:
    """Rows from 1 of the names in at least ``LEAST`` texts, most texts first, at most ``most - 1``."""
    ranked = sorted((x for x in counts.items() if x[1] >= LEAST), key=lambda x: (-x[1], x[0]))[: most - 1]
    return {name: at + 1 for at, (name, _) in enumerate(ranked)}


def context_sums(texts: Sequence[bytes], word_rows: dict[bytes, int], shape_rows: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the index vectors around every word and shape of ``texts``: what random indexing
    adds up, before it is normalised. Sums of several parts of a sample add up to the sample's."""
    reader = Rows(word_rows, shape_rows)
    w_place, w_sign = index_places([b"", *(b"w" + name for name in word_rows)])
    s_place, s_sign = index_places([b"", *(b"s" + name for name in shape_rows)])
    rows = [reader.of(text) for text in texts]
    gap = [np.full(AROUND, -1)]
    w = np.concatenate([x for word, _ in rows for x in (word, *gap)] or gap)
    s = np.concatenate([x for _, shape in rows for x in (shape, *gap)] or gap)

    def context(center: np.ndarray, size: int, around: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]) -> np.ndarray:
        total = np.zeros(size * SIZE)
        for other, shift, place, sign in around:
            a, b = (center[shift:], other[: len(other) - shift]) if shift >= 0 else (center[:shift], other[-shift:])
            both = (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            for at in range(NONZERO):
                total += np.bincount(a * SIZE + place[b, at], weights=sign[b, at], minlength=size * SIZE)
        return total.reshape(size, SIZE)

    shifts = [x for x in range(-AROUND, AROUND + 1) if x]
    near_words, near_shapes = [(w, x, w_place, w_sign) for x in shifts], [(s, x, s_place, s_sign) for x in shifts]
    own_shape, own_word = (s, 0, s_place, s_sign), (w, 0, w_place, w_sign)
    return context(w, len(word_rows) + 1, [*near_words, own_shape]), context(s, len(shape_rows) + 1, [*near_shapes, own_shape, own_word])


def normalised(table: np.ndarray) -> np.ndarray:
    table = table.copy()
    table[0] = 0.0
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def learn_vectors(texts: Sequence[bytes]) -> Vectors:
    """Random indexing over the sampled texts. Words are known by the texts they occur in, so that
    what one text repeats looks as unknown in the sample as it would elsewhere."""
    words, shapes = token_counts(texts)
    word_rows, shape_rows = numbered(words, MOST_WORDS), numbered(shapes, MOST_SHAPES)
    word_sums, shape_sums = context_sums(texts, word_rows, shape_rows)
    return Vectors(word_rows, shape_rows, normalised(word_sums), normalised(shape_sums))


def learn_vectors_in_tasks(sample: DataFrame, text: str = "text") -> Vectors:
    """``learn_vectors`` over the texts of ``sample``, computed where they lie: each task counts
    its texts' words and shapes and sums their contexts; only the counts of names and the sums
    of known rows (``MOST_WORDS`` and ``MOST_SHAPES`` of ``SIZE``) are brought together."""
    spark = sample.sparkSession
    small_batches(spark)
    names = T.StructType([T.StructField("kind", T.StringType()), T.StructField("name", T.BinaryType()), T.StructField("n", T.LongType())])

    def count(batches):
        for batch in batches:
            words, shapes = token_counts(as_bytes(batch.column(text)))
            kinds = ["w"] * len(words) + ["s"] * len(shapes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([*words, *shapes], pa.binary()), pa.array([*words.values(), *shapes.values()], pa.int64())],
                names.names,
            )

    counted = sample.select(text).mapInArrow(count, names).groupBy("kind", "name").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    words, shapes = Counter(), Counter()
    for kind, most, into in (("w", MOST_WORDS, words), ("s", MOST_SHAPES, shapes)):
        top = counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "name").limit(most - 1).collect()
        into.update({bytes(row["name"]): row["n"] for row in top})
    word_rows, shape_rows = numbered(words, MOST_WORDS), numbered(shapes, MOST_SHAPES)
    sent = spark.sparkContext.broadcast((word_rows, shape_rows))
    sums = T.StructType([T.StructField("kind", T.StringType()), T.StructField("row", T.LongType()), T.StructField("sum", T.ArrayType(T.DoubleType()))])

    def add(batches):
        rows_of = sent.value
        word_sums, shape_sums = np.zeros((len(rows_of[0]) + 1, SIZE)), np.zeros((len(rows_of[1]) + 1, SIZE))
        for batch in batches:
            w, s = context_sums(as_bytes(batch.column(text)), *rows_of)
            word_sums += w
            shape_sums += s
        for kind, table in (("w", word_sums), ("s", shape_sums)):
            some = np.flatnonzero(np.abs(table).sum(axis=1) > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(table[some].tolist(), pa.list_(pa.float64()))],
                sums.names,
            )

    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    added = sample.select(text).mapInArrow(add, sums).groupBy("kind", "row").agg(Summarizer.sum(array_to_vector("sum")).alias("sum"))
    word_sums, shape_sums = np.zeros((len(word_rows) + 1, SIZE)), np.zeros((len(shape_rows) + 1, SIZE))
    for row in added.select("kind", "row", vector_to_array("sum").alias("sum")).toLocalIterator():
        (word_sums if row["kind"] == "w" else shape_sums)[row["row"]] = row["sum"]
    return Vectors(word_rows, shape_rows, normalised(word_sums), normalised(shape_sums))


def pooled(rows: tuple[np.ndarray, np.ndarray], vectors: Vectors) -> np.ndarray:
    """A document's features: both means, shares of unknown words and shapes and of distinct
    words, and the logarithm of its length. All 0 for a text without tokens."""
    words, shapes = rows
    count = len(words)
    if not count:
        return np.zeros(2 * SIZE + 4, np.float32)
    counted = np.bincount(shapes)
    some = np.flatnonzero(counted)
    by_shape = counted[some].astype(np.float32) @ vectors.shape_vectors[some] / count
    rest = [np.mean(words == 0), np.mean(shapes == 0), len(np.unique(words)) / count, np.log1p(count)]
    return np.concatenate([vectors.word_vectors[words].mean(axis=0), by_shape, rest]).astype(np.float32)


@dataclass
class Network:
    """Two layers on standardised features, and the temperature of its logits."""

    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.tanh(z @ self.first + self.first_bias) @ self.second + self.second_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 5) -> Network:
    """Fit by Adam on all rows but each ``HELD``-th, and the temperature on those."""
    held = np.arange(len(y)) % HELD == 0
    if held.all() or len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    fit = ~held
    random = np.random.default_rng(seed)
    spread = x[fit].std(axis=0)
    net = Network(
        x[fit].mean(axis=0),
        np.where(spread < 1e-6, 1.0, spread),
        random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        0.0,
    )
    z, t, w = np.clip((x[fit] - net.mean) / net.spread, -8, 8), y[fit], weight[fit] / weight[fit].mean()
    values = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(t))
        for start in range(0, len(t), STEP_ROWS):
            at = order[start : start + STEP_ROWS]
            a, b, c, d = values
            hidden = np.tanh(z[at] @ a + b)
            error = (1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30))) - t[at]) * w[at] / len(at)
            back = np.outer(error, c) * (1 - hidden**2)
            slopes = [z[at].T @ back + DECAY * a, back.sum(axis=0), hidden.T @ error + DECAY * c, error.sum(keepdims=True)]
            step += 1
            for value, slope, (m, v) in zip(values, slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(values[3][0])
    if held.any():
        logits, t, w = net.logits(x[held]), y[held], weight[held]
        loss = lambda heat: float((w * np.logaddexp(0, np.where(t == 1, -logits, logits) / heat)).sum())
        net.temperature = min(np.geomspace(0.25, 8, 141), key=loss)
    return net


@dataclass
class Model:
    """``network`` is None where no labels, or those of one value only, were given: ``constant`` is
    then the score of every text."""

    vectors: Vectors
    network: Network | None
    constant: float

    def scores(self, texts: Sequence[bytes | None], reader: Rows) -> np.ndarray:
        if self.network is None or not len(texts):
            return np.full(len(texts), self.constant)
        return self.network.probabilities(np.stack([pooled(reader.of(text), self.vectors) for text in texts]))


def learn_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the whole texts of ``docs`` that ``labels`` (``key, label`` 0 or 1) marks.

    At most ``SAMPLE_TEXTS`` keys of either label, those that hash lowest, are drawn; a key that
    ``docs`` repeats gives one of its texts (the one whose hash is lowest), so the sample stays
    bounded however often a key repeats. Vectors are learned from the sample in tasks and the
    features pooled there; only they reach the driver, which trains the network. Weights restore
    the share the label has among all labelled keys.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null and label in (0, 1)")
    counts = {row.label: row["count"] for row in marked.groupBy("label").count().collect()}
    chosen = drawn(marked, "label", "key", SAMPLE_TEXTS, counts, 23)
    # A key labelled more than once counts once, by its first place.
    chosen = chosen.groupBy("key").agg(F.min(F.struct("place", "label")).alias("first")).select("key", "first.place", "first.label")
    # Bounded by the sample's size, so it may go to every task.
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    one = found.groupBy("key", "place", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = stored(one.select("place", "label", "key", "text"), "quality-sample")
    vectors = learn_vectors_in_tasks(sample)
    total = sum(counts.values())
    sent = spark.sparkContext.broadcast(vectors)
    features = T.StructType([T.StructField("place", T.LongType()), T.StructField("key", sample.schema["key"].dataType), T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.FloatType()))])

    def pool(batches):
        reader = sent.value.reader()
        for batch in batches:
            x = [pooled(reader.of(t), sent.value).tolist() for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("place").cast(pa.int64()), batch.column("key"), batch.column("label"), pa.array(x, pa.list_(pa.float32()))], features.names)

    small_batches(spark)
    rows = sorted((row.place, row.key, row.label, row.x) for row in sample.mapInArrow(pool, features).collect())
    y = np.array([row[2] for row in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return Model(vectors, None, counts.get(1, 0) / total if total else 0.5)
    share = np.array([counts.get(0, 0) / total, counts.get(1, 0) / total])
    seen = np.array([np.mean(y == 0), np.mean(y == 1)])
    x = np.array([row[3] for row in rows], np.float64)
    return Model(vectors, train_network(x, y, (share / seen)[y.astype(int)]), float(share[1]))


def score_quality(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all but ``text``) and ``score``, the probability of label 1, and
    ``predicted``, 1 if it is ``THRESHOLD`` or more, else 0.

    Whole texts are read. Null and empty texts have no tokens and get the network's score for
    that; repeated rows score alike; rows stay where they are. The model sent to all tasks is
    bounded by ``MOST_WORDS`` and ``MOST_SHAPES`` vectors.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        model = sent.value
        reader = model.vectors.reader()

        def work(texts: pa.Array) -> list[pa.Array]:
            scores = model.scores(as_bytes(texts), reader)
            return [pa.array(scores, pa.float64()), pa.array(scores >= THRESHOLD).cast(pa.int32())]

        return work

    return mapped(docs, text, [c for c in docs.columns if c != text] if keep is None else keep, FIELDS, make)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted 1, with all their columns."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        model = sent.value
        reader = model.vectors.reader()
        return lambda texts: pa.array(model.scores(as_bytes(texts), reader) >= THRESHOLD)

    return filtered(docs, text, make)
