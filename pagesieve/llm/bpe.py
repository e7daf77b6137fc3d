"""Byte-level BPE by tree reduction: halves are encoded apart and joined at their seam.

A text is halved until its pieces are small. Two neighbours are joined by encoding anew only a
window around the seam, grown on either side to a place where the split into words provably
does not depend on what lies beyond: a blank or line feed after a character that is no white
space always begins a match of the pattern. Tokens outside the window stay as they are.
Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import as_bytes, mapped

#: Characters of a piece that is encoded at once, first width of a seam's window, tokens decoded at once.
LEAF, SEAM, LEAF_TOKENS = 1024, 32, 4096
SAFE = re.compile(r"(?<=\S)[ \n]")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder for one rank table and pattern. The pattern must begin a match at every
    blank or line feed that follows no white space, as those that take at most one leading blank do."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str) -> None:
        import tiktoken

        self.pieces = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=dict(ranks), special_tokens={})
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.sizes = np.fromiter(map(len, self.table), np.int64, len(self.table))

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text``, no special tokens."""
        return self._encode(text, 0, len(text))

    def _leaf(self, text: str) -> np.ndarray:
        return np.array(self.pieces.encode_ordinary(text), np.uint32)

    def _encode(self, text: str, low: int, high: int) -> np.ndarray:
        if high - low <= LEAF:
            return self._leaf(text[low:high])
        middle = (low + high) // 2
        return self._join(text, low, middle, high, self._encode(text, low, middle), self._encode(text, middle, high))

    def _join(self, text: str, low: int, middle: int, high: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        begin, end = before_seam(text, low, middle), after_seam(text, middle, high)
        kept = len(left) - self._covering(left[::-1], len(text[begin:middle].encode()))
        gone = self._covering(right, len(text[middle:end].encode()))
        return np.concatenate([left[:kept], self._leaf(text[begin:end]), right[gone:]])

    def _covering(self, ids: np.ndarray, size: int) -> int:
        """How many of the leading ``ids`` take up ``size`` bytes."""
        if not size:
            return 0
        width = SEAM
        while True:
            ends = np.cumsum(self.sizes[ids[:width]])
            if ends[-1] >= size:
                at = int(np.searchsorted(ends, size))
                if ends[at] != size:
                    raise AssertionError("a token crosses a place that begins a match")
                return at + 1
            width *= 2

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            table = self.table
            return b"".join([table[at] for at in ids.tolist()])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def before_seam(text: str, low: int, middle: int) -> int:
    """The last safe place of ``low..middle``; ``low`` without one."""
    width = SEAM
    while True:
        start = max(low, middle - width)
        places = [match.start() for match in SAFE.finditer(text[start:middle])]
        if places:
            return start + places[-1]
        if start == low:
            return low
        width *= 2


def after_seam(text: str, middle: int, high: int) -> int:
    """The first safe place of ``middle..high``; ``high`` without one."""
    width = SEAM
    while True:
        end = min(high, middle + width)
        if place := SAFE.search(text[middle:end]):
            return middle + place.start()
        if end == high:
            return high
        width *= 2


def encode_texts(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all but ``text``) and ``n_tokens`` and ``ids``, the ids as
    little-endian unsigned 32-bit integers, of every row.

    ``path`` is the rank file's place on every executor. Null counts as empty and has no tokens;
    bytes that are no UTF-8 are read as U+FFFD. Rows stay where they are; a text is one row's
    work, in time linear in its length.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]

    def make():
        codec = Codec(read_ranks(path), pattern)

        def work(texts):
            ids = [codec.encode((text or b"").decode("utf-8", "replace")).astype("<u4", copy=False) for text in as_bytes(texts)]
            return [pa.array(list(map(len, ids)), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]

        return work

    return mapped(docs, text, [c for c in docs.columns if c != text] if keep is None else keep, fields, make)


def decode_ids(encoded: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but ``ids``) and ``decoded``, the bytes the column ``ids`` stands
    for. Null ids decode to nothing."""

    def make():
        codec = Codec(read_ranks(path), pattern)
        return lambda ids: [pa.array([codec.decode(np.frombuffer(x or b"", "<u4")) for x in ids.to_pylist()], pa.binary())]

    return mapped(encoded, "ids", [c for c in encoded.columns if c != "ids"] if keep is None else keep, [T.StructField("decoded", T.BinaryType())], make)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: texts encoded, and their ids decoded again."""
    encoded = encode_texts(docs, path, pattern, [key]).select(key, "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))
    decoded = decode_ids(encoded, path, pattern, [key, "n_tokens", "ids_sha256"])
    return decoded.select(key, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
