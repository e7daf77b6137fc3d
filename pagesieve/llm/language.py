"""Language ID by compression: the language whose dictionary packs a text smallest.

For every language a raw-content Zstandard dictionary is made of sampled labelled texts. A text
is compressed, block by block, with each dictionary; the smallest sum wins, and where the
second smallest is nearly as small the text is rejected. Very short texts, which no dictionary
makes smaller than they are, are compressed behind a piece that leaves room to gain.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import as_bytes, drawn, filtered, mapped, small_batches

#: Texts drawn per language, bytes of a dictionary, languages at most: the bounds of what is
#: learned from. Drawn texts are taken whole, in the order drawn, until the dictionary is full.
SAMPLE_TEXTS, DICTIONARY_BYTES, MOST_LANGUAGES = 400, 96 << 10, 400
#: Bytes compressed at a time: so short that the dictionary matters more than the text before.
BLOCK_BYTES = 4096
#: Compression level; texts of fewer bytes are searched for shorter matches, which takes longer.
LEVEL, SHORT_BYTES = 6, 256
#: What stands before texts that would be stored raw: it packs into a few bytes, so the block is compressed.
WARM_UP = b" " * 512
#: Bytes of words, closed by blanks, up to which pointing into a dictionary is no shorter than the words.
UNDECIDED_BYTES = 8
#: Least margin, of the second smallest size, at which a text is not rejected.
MARGIN = 0.005
#: Margin at which the score is 1 - 1/e.
SCALE = 0.05
UNKNOWN = "und"

#: A letter: any character of Unicode's general category L; number signs such as ½ or Ⅷ are none.
LETTER = regex.compile(r"\p{L}")
#: The same for Spark.
HAS_LETTER = r"\p{L}"
#: ASCII letters and all bytes beyond ASCII stay, the rest separates.
LETTER_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("margin", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
]


def letters_of(text: bytes | None) -> bytes | None:
    """The text's words in lower case, closed by blanks; None if it has no letter."""
    if not text:
        return None
    plain = text.decode("utf-8", "replace")
    if not LETTER.search(plain):
        return None
    words = plain.lower().encode().translate(LETTER_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else None


def learn_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary's content per language, from the rows with a language and a text with a letter.

    ``SAMPLE_TEXTS`` texts of a language, those whose keys hash lowest, are taken whole, in that
    order, until ``DICTIONARY_BYTES`` are filled (the last one as far as it fits); only texts that
    can still add to it leave the tasks. The languages come in the order of their rows, most
    first. No rows give no languages; more than ``MOST_LANGUAGES`` raise.
    """
    known = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    known = known.where(F.col("text").rlike(HAS_LETTER))
    ranked = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(ranked) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: merge some")
    counts = {row.lang: row["count"] for row in ranked}
    parts: dict[str, list[bytes]] = {name: [] for name in counts}
    chosen = drawn(known, "lang", "key", SAMPLE_TEXTS, counts, 17)
    # Letters are fewer bytes than the text, so twice the dictionary of raw bytes is enough.
    earlier = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(earlier), F.lit(0)))
    chosen = chosen.where(F.col("before") < 2 * DICTIONARY_BYTES)
    for row in chosen.orderBy("lang", "place", "text").select("lang", "text").toLocalIterator():
        had = parts[row.lang]
        if sum(map(len, had)) < DICTIONARY_BYTES and (words := letters_of((row.text or "").encode())):
            had.append(words)
    return {name: b"".join(had)[:DICTIONARY_BYTES] for name, had in parts.items() if had}


class Packer:
    """Compressed sizes of a text under every dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        import zstandard as z

        bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        search = {"window_log": 17, "chain_log": 17, "hash_log": 17, "search_log": 9, "min_match": 3, "strategy": z.STRATEGY_BTLAZY2}
        self.names, self.packers, self.short = list(dictionaries), [], []
        for content in dictionaries.values():
            data = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            self.short.append(z.ZstdCompressor(dict_data=data, compression_params=z.ZstdCompressionParameters(**search, **bare)))
            data = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.packers.append(z.ZstdCompressor(dict_data=data, **bare))

    def sizes(self, text: bytes) -> np.ndarray:
        packers = self.short if len(text) < SHORT_BYTES else self.packers
        blocks = [text[at : at + BLOCK_BYTES] for at in range(0, len(text), BLOCK_BYTES)]
        return np.array([sum(len(packer.compress(block)) for block in blocks) for packer in packers], np.int64)

    def warm_sizes(self, text: bytes) -> np.ndarray:
        """Sizes behind ``WARM_UP``, less its own."""
        return np.array([len(packer.compress(WARM_UP + text)) - len(packer.compress(WARM_UP)) for packer in self.short], np.int64)

    def judge(self, text: bytes | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, rejected. Of equal sizes the first language wins, with margin 0."""
        words = letters_of(text)
        if words is None or not self.names:
            return UNKNOWN, 0.0, 0.0, True
        if len(self.names) == 1:
            return self.names[0], 1.0, 1.0, False
        sizes = self.sizes(words)
        # The smallest is no smaller than the text: it is stored raw under every dictionary.
        if sizes.min() == sizes.max() and sizes.min() > len(words) and len(words) < SHORT_BYTES:
            sizes = np.maximum(self.warm_sizes(words), 1)
        best, second = np.argsort(sizes, kind="stable")[:2]
        margin = float((sizes[second] - sizes[best]) / sizes[second])
        return self.names[best], 1.0 - float(np.exp(-margin / SCALE)), margin, margin < MARGIN


    def stays(self, text: bytes | None) -> bool:
        """Whether the language is not rejected, or the text has letters but too few for any to be found."""
        words = letters_of(text)
        return words is not None and bool(self.names) and (len(words) <= UNDECIDED_BYTES or not self.judge(text)[3])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all but ``text``) and ``lang_pred, score, margin, rejected``.

    ``lang_pred`` is a learned language, ``und`` for null texts and those without letters (or if
    none was learned); these have score 0 and are rejected. ``margin`` is how much smaller the
    best size is, as a share of the second best. Whole texts are read; repeated rows are judged
    alike; rows stay where they are. The dictionaries are sent to all tasks: at most
    ``MOST_LANGUAGES`` of ``DICTIONARY_BYTES``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def make() -> Callable:
        packer = Packer(sent.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            judged = [packer.judge(text) for text in as_bytes(texts)]
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            return [pa.array([row[at] for row in judged], kind) for at, kind in enumerate(types)]

        return work

    return mapped(docs, text, [c for c in docs.columns if c != text] if keep is None else keep, FIELDS, make)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns; texts of up to
    ``UNDECIDED_BYTES`` stay, since nothing speaks against them."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def make() -> Callable:
        packer = Packer(sent.value)
        return lambda texts: pa.array([packer.stays(x) for x in as_bytes(texts)], pa.bool_())

    return filtered(docs, text, make)
