"""Near-duplicates by MinHash: fast similarity sketching, banding, exact verification.

A set of word shingles is sketched in rounds: every round places all its elements into bins by a
new hash, each bin keeping its smallest value, until every bin is filled; late rounds place
elements into one given bin, so that filling is certain. Values of earlier rounds are smaller, so
sketches of different sets can be compared bin by bin. Bands of bins bring likely pairs together,
and each link is confirmed on the full sets.

Documents with equal sets are one class and take part once, under a number of its own, so that
neither repeated nor missing keys tie classes together. Inside a band's bucket not all pairs
are formed: members are compared with its smallest one. Where that leaves a bucket in several
components, its members meet again by their rarest shingles, in buckets that hold every pair
which can still be linked; such a bucket is cut into tiles of bounded size, in which all pairs
are compared at once and only links between different components come out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import LOWER, as_bytes, mapped
from pagesieve.session import stored

A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LOW32, SHIFT32 = np.uint64(0xFFFFFFFF), np.uint64(32)
#: Words whose hashes a task remembers; characters of texts sketched together.
REMEMBERED, BLOCK = 200_000, 1 << 21


@dataclass(frozen=True)
class Likeness:
    """Words per shingle; documents are linked when 100 * common >= percent * united shingles.

    ``bands`` of ``rows`` bins: a pair at the threshold is missed by all bands with probability
    ``(1 - (percent / 100) ** rows) ** bands``.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 40

    @property
    def missed(self) -> float:
        return (1 - (self.percent / 100) ** self.rows) ** self.bands


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes | None, size: int, words_of: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of ``size`` words; of all its words where they
    are fewer; none for a text without words. A-Z count as a-z, white space is ASCII's."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(words_of.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for at in range(size):
        total = mixed(total * A + each[at : len(words) - size + 1 + at])
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def bin_sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches: one row of ``bins`` values for every set, none of them empty."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    owner, element = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    least = np.full(len(sets) * bins, np.iinfo(np.uint64).max, np.uint64)
    table = least.reshape(len(sets), bins)
    seeds = mixed(np.arange(1, 2 * bins + 1, dtype=np.uint64) * A)
    for turn in range(2 * bins):
        h = mixed(element ^ seeds[turn])
        # The first rounds choose a bin by the hash, the later ones fill one bin each for certain.
        bin_of = ((h >> SHIFT32) * np.uint64(bins)) >> SHIFT32 if turn < bins else np.uint64(turn - bins)
        np.minimum.at(least, owner * bins + np.asarray(bin_of, np.int64), (np.uint64(turn) << SHIFT32) | (h & LOW32))
        open_rows = (table == np.iinfo(np.uint64).max).any(axis=1)
        if not open_rows.any():
            break
        stay = open_rows[owner]
        owner, element = owner[stay], element[stay]
    return table


def band_hashes(table: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit hash per row and band, the band's number included."""
    cut = table[:, : rows * bands].reshape(len(table), bands, rows)
    out = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * A), (len(table), bands))
    for at in range(rows):
        out = mixed(out * A + cut[:, :, at])
    return out.view(np.int64)


SKETCHED = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_id", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
]


def sketch_texts(docs: DataFrame, how: Likeness, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``n_shingles, set_id, bands``; the last two are null without
    shingles. ``set_id`` is equal for equal sets."""
    bins = how.rows * how.bands

    def make() -> Callable:
        words = WordHashes()

        def work(texts: pa.Array) -> list[pa.Array]:
            count, ids, bands = [], [], []
            every, at = as_bytes(texts), 0
            while at < len(every):
                end, size = at, 0
                while end < len(every) and (end == at or size < BLOCK):
                    size += len(every[end] or b"")
                    end += 1
                sets = [shingle_hashes(x, how.shingle, words) for x in every[at:end]]
                full = [x for x in sets if len(x)]
                hashes = iter(band_hashes(bin_sketch(full, bins), how.rows, how.bands) if full else ())
                for x in sets:
                    count.append(len(x))
                    ids.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                    bands.append(next(hashes) if len(x) else None)
                at = end
            return [pa.array(count, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]

        return work

    return mapped(docs, text, keep, SKETCHED, make)


def full_sets(docs: DataFrame, how: Likeness, key: str, text: str = "text") -> DataFrame:
    """``key, shingles``: the whole sets, as hashes."""

    def make() -> Callable:
        words = WordHashes()
        return lambda texts: [pa.array([shingle_hashes(x, how.shingle, words).view(np.int64) for x in as_bytes(texts)], pa.list_(pa.int64()))]

    return mapped(docs, text, [key], [T.StructField("shingles", T.ArrayType(T.LongType()))], make)


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (``u, v``): label is the smallest node of the
    component, ``node`` all others.

    Alternating star contraction: every node's larger neighbours are hung on its smallest one,
    then its smaller ones; both only aggregate and join, the edges never grow in number, and each
    round is written out, so that lineage stays short. It ends when all hang on roots.
    """
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        count = e.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if count[0] == count[1] and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        hung = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(hung.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose sets are alike enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("b_set"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(100 * common >= percent * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


def digest(key: str, text: str) -> Column:
    """16 bytes, never null, that tell rows apart by key and text."""
    binary = lambda x: x.cast("binary")
    name = F.col(key).cast("string")
    name = F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.md5(F.concat(binary(name), F.coalesce(F.concat(binary(F.lit("+")), binary(F.col(text))), binary(F.lit("-"))))))


def link(docs: DataFrame, how: Likeness, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable over links, the row's own included; it is null
    where none of them has a key. Null and empty texts and those without words have no shingles
    and no links. Rows that repeat a key, or have none, with another text each link on their own;
    other columns are not read; no rows give none.
    """
    sketched, tops = _linked(docs, how, key, text)
    linked = sketched.where("n_shingles > 0").join(tops, "set_id").select("key", "n_shingles", F.col("top.key").alias("component_id"))
    alone = sketched.where("n_shingles = 0").select("key", "n_shingles", F.col("key").alias("component_id"))
    return linked.union(alone).withColumnRenamed("key", key)


def _linked(docs: DataFrame, how: Likeness, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The stored sketches (``key, digest, n_shingles, set_id``), and ``set_id, top`` for every
    set: the row that stands for its component, the one with the smallest key, then digest."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), digest(key, text).alias("digest"))
    sketched = stored(sketch_texts(rows, how, ["key", "digest"]), "sketches")
    # Rows without a key come last.
    row = F.struct(F.col("key").isNull().alias("no_key"), "key", "digest")
    classes = sketched.where("n_shingles > 0").groupBy("set_id").agg(F.min(row).alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    # Numbers are fixed by being stored: whichever attempt of a task counts, they differ.
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    live = stored(members.join(buckets.select("bucket", "pivot"), "bucket"), "members")

    # One text stands for its class: rows equal in key and text give one set.
    wanted = classes.join(live.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("row.digest").alias("digest"))
    texts = rows.join(wanted, "digest").select("rep", "text")
    sets = stored(full_sets(texts, how, "rep").distinct(), "sets")

    pairs = live.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = stored(confirmed(pairs, sets, how.percent), "links")
    labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    left = unresolved(live.where("rep <> pivot").select("bucket", "rep", "n"), labels)
    if not left.isEmpty():
        labels = settle(prefix_buckets(left.select("rep").distinct(), sets, how.percent), sets, labels, how.percent)

    named = classes.select("set_id", "rep", "row").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_id", "row", F.coalesce("label", "rep").alias("label"))
    tops = named.groupBy("label").agg(F.min("row").alias("top"))
    return sketched, named.join(tops, "label").select("set_id", "top")


def prefix_buckets(reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``bucket, rep, n, place``: buckets of ``reps`` in which every linked pair of them meets.

    Shingles are ordered by how many of the sets hold them, the rarest first. Two linked sets of
    n and m shingles share at least ``percent (n + m) / (100 + percent)``, so their first common
    shingle stands early in both, with at least so many from there on: ``place`` counts those
    before it. A set whose own shingles are too many for any link drops out.
    """
    each = sets.join(reps, "rep", "left_semi").select("rep", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("bucket"))
    common = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    ordered = each.join(common, "bucket").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("held", "bucket"))).alias("shared"))
    own = F.col("n") - F.size("shared")
    early = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - own
    cut = ordered.where(early > 0).select("rep", "n", own.alias("own"), F.posexplode(F.slice("shared", F.lit(1), early.cast("int"))).alias("at", "s"))
    return stored(cut.select(F.col("s.bucket").alias("bucket"), "rep", "n", (F.col("own") + F.col("at")).alias("place")), "prefixes")


#: Members of a bucket dealt to one block; a tile holds the members of two blocks.
TILE = 512
#: Shingle columns of the bit rows multiplied at once inside a tile.
COLUMNS = 4096
EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def settle(live: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The components when all pairs that meet in a bucket of ``live`` and are alike are linked.

    Buckets that hold one component are done. Buckets of more than ``TILE`` members are cut into
    tiles (below); the others are settled by pivots (``settle_by_pivots``), which compare each
    pair once however many buckets it meets in, while a tile carries whole sets. Both are exact.

    In a bucket cut into tiles the members of its largest
    component (``big``) need not meet each other; the rest (``small``) meet each other and the
    big ones. Both sides are dealt by hash to blocks of ``TILE``; a tile is a pair of small blocks
    (one with itself included) or a small block with a big one, at most ``2 * TILE`` members, and
    every pair that must be compared meets in exactly one tile. A big member goes to as many tiles
    as there are small blocks, a small one to as many as there are blocks. A tile compares its
    members as bit rows over the shingles that two of them hold, all pairs at once by a matrix
    product, and gives out only the links that join two of its components (union-find, seeded
    with the components already known): a spanning forest, fewer links than members.
    """
    live = unresolved(live, labels)
    if live.isEmpty():
        return labels
    many = live.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > TILE)
    small = live.join(many, "bucket", "left_anti").drop("comp")
    hot = live.join(many.select("bucket"), "bucket", "left_semi")
    if not hot.isEmpty():
        labels = tiled(hot, sets, labels, percent)
    return settle_by_pivots(small, sets, labels, percent)


def tiled(live: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``settle`` for buckets of ``live`` (with ``comp``) by tiles."""
    sizes = live.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    biggest = sizes.groupBy("bucket").agg(
        F.max(F.struct("c", (-F.col("comp")).alias("minus"))).alias("top"), F.sum("c").alias("m")
    )
    shape = biggest.select(
        "bucket",
        (-F.col("top.minus")).alias("big"),
        F.ceil((F.col("m") - F.col("top.c")) / TILE).cast("int").alias("small_blocks"),
        F.ceil(F.col("top.c") / TILE).cast("int").alias("big_blocks"),
    )
    dealt = live.join(shape, "bucket").withColumn("is_big", F.col("comp") == F.col("big"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("is_big"), F.col("big_blocks")).otherwise(F.col("small_blocks")))
    dealt = dealt.withColumn("own", own.cast("int"))
    # A tile is (kind, lo, hi): kind 0 pairs small blocks lo <= hi, kind 1 small block lo with big block hi.
    small_side = F.sequence(F.lit(0), F.col("small_blocks") - 1)
    big_side = F.sequence(F.lit(0), F.col("big_blocks") - 1)
    tile = lambda kind, lo, hi: F.struct(F.lit(kind).alias("kind"), lo.alias("lo"), hi.alias("hi"))
    as_small = F.concat(
        F.transform(small_side, lambda o: tile(0, F.least(F.col("own"), o), F.greatest(F.col("own"), o))),
        F.transform(big_side, lambda o: tile(1, F.col("own"), o)),
    )
    as_big = F.transform(small_side, lambda o: tile(1, o, F.col("own")))
    tiles = dealt.select(
        "bucket", "rep", "comp",
        # Blocks of the two sides are told apart inside a tile.
        F.when(F.col("is_big"), -1 - F.col("own")).otherwise(F.col("own")).alias("block"),
        F.explode(F.when(F.col("is_big"), as_big).otherwise(as_small)).alias("tile"),
    ).select("bucket", "rep", "comp", "block", "tile.kind", "tile.lo", "tile.hi")

    def link_tile(frame):
        import pandas as pd

        return pd.DataFrame(tile_links(frame, percent), columns=["a", "b"])

    with_sets = tiles.join(sets, "rep")
    found = stored(with_sets.groupBy("bucket", "kind", "lo", "hi").applyInPandas(link_tile, EDGES), "links")
    if found.isEmpty():
        return labels
    known = labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
    return components(known.union(found.select(F.col("a").alias("u"), F.col("b").alias("v"))))


def settle_by_pivots(live: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The components when all pairs that meet in a bucket of ``live`` and may be linked are too,
    for buckets of at most ``TILE`` members.

    The smallest members of each component in a bucket are compared with the members of others,
    then leave the bucket; buckets of one component are done. The number of such pivots doubles,
    so that few rounds are needed whatever a bucket's size.
    """
    pivots = 1
    while True:
        live = unresolved(live, labels)
        if live.isEmpty():
            return labels
        order = F.row_number().over(Window.partitionBy("bucket", "comp").orderBy("rep"))
        chosen = stored(live.withColumn("order", order).where(F.col("order") <= pivots).drop("order"), "pivots")
        other = chosen.select("bucket", *(F.col(name).alias(f"p_{name}") for name in ("rep", "n", "place", "comp")))
        rest = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place"))
        near = (100 + percent) * rest >= percent * (F.col("n") + F.col("p_n"))
        pairs = live.join(other, "bucket").where((F.col("comp") != F.col("p_comp")) & near)
        pairs = pairs.select(F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b")).distinct()
        found = stored(confirmed(pairs, sets, percent), "links")
        live = live.join(chosen.select("bucket", "rep"), ["bucket", "rep"], "left_anti").drop("comp")
        pivots *= 2
        if not found.isEmpty():
            known = labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
            labels = components(known.union(found.select(F.col("a").alias("u"), F.col("b").alias("v"))))




def tile_links(frame, percent: int) -> list[tuple[int, int]]:
    """Links of one tile (``rep, comp, block, kind, lo, hi, shingles``) that join two components."""
    reps, comps = frame["rep"].to_numpy(np.int64), frame["comp"].to_numpy(np.int64)
    blocks = frame["block"].to_numpy(np.int64)
    sets = [np.asarray(x, np.int64) for x in frame["shingles"]]
    k = len(reps)
    if k < 2:
        return []
    sizes = np.fromiter(map(len, sets), np.int64, k)
    every, owner = np.concatenate(sets), np.repeat(np.arange(k), sizes)
    _, column, held = np.unique(every, return_inverse=True, return_counts=True)
    shared = held[column] >= 2
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((k, k), np.float64)
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        part = (column >= first) & (column < first + COLUMNS)
        bits = np.zeros((k, COLUMNS), np.float32)
        bits[owner[part], column[part] - first] = 1.0
        common += bits @ bits.T
    union = sizes[:, None] + sizes[None, :] - common
    alike = 100 * common >= percent * union
    # A pair of one block is met in that block's own tile only.
    kind, lo, hi = frame["kind"].iloc[0], frame["lo"].iloc[0], frame["hi"].iloc[0]
    apart = blocks[:, None] != blocks[None, :] if kind or lo != hi else np.ones((k, k), bool)
    a, b = np.nonzero(np.triu(alike & apart & (comps[:, None] != comps[None, :]), 1))
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    links = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(int(comps[i])), root(int(comps[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((int(reps[i]), int(reps[j])))
    return links


def unresolved(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the members those in buckets of several components, with ``comp``."""
    named = live.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
    named = named.select(*live.columns, F.coalesce("label", "rep").alias("comp"))
    split = named.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    return stored(named.join(split.select("bucket"), "bucket", "left_semi"), "unresolved")


def keep_one(docs: DataFrame, how: Likeness = Likeness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component, one of each, with all their columns.

    It is the row with the smallest key, then digest; rows without a key come last. Texts
    without words are linked with nothing and stay. Of rows equal in key and text one stays.
    """
    sketched, tops = _linked(docs, how, key, text)
    kept = tops.select(F.col("top.digest").alias("__own")).union(sketched.where("n_shingles = 0").select("digest")).distinct()
    # Texts are dealt out and sorted once, for the join and for repeats alike.
    return docs.withColumn("__own", digest(key, text)).join(kept, "__own", "left_semi").dropDuplicates(["__own"]).select(*docs.columns)
