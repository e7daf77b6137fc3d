"""URL filters: nested allow and block rules by a sort-merge range join.

A host's labels, reversed and each closed by a dot, make a key in which a host and all its
subdomains are one interval of the sort order. Rules and URLs are sorted together by that key;
a sweep over the sorted rows keeps a stack of the rule hosts whose interval is open, and each
URL is judged by the open hosts' path rules. The sort is cut into ranges; a rule goes into every
range its interval touches, so ranges are swept apart from each other.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import shuffle_partitions, small_batches

#: Keys drawn per range to place the cuts. Cuts decide only how even the ranges are.
DRAWN = 100
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = "\U0010ffff"

RULES = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without one."""
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, SMALL)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """``a.example.org`` as ``org.example.a.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def judge_urls(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of ``urls``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains when the
    URL's path starts with the rule's; the longest host plus path wins, among rules of one
    length that with the longer host, and of equal rules the one that blocks. ``rule`` is host
    and path of the winner, else null, and then ``default`` is the verdict. A null URL or one
    without ``://`` has empty host and path and fits no rule; rules with an empty or null host
    fit nothing, a null rule path counts as empty. Repeated rows are judged each; an empty table
    gives an empty result; other columns are not read.

    A hot host is cut by path and a hash of ``key``. One task holds the rules of the hosts open
    at a time, never all rules.
    """
    spark = urls.sparkSession
    small_batches(spark)
    ranges = shuffle_partitions(spark)
    asked = urls.select(F.col(key).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")).select(
        "id", "host", "path", host_key(F.col("host")).alias("key"), F.xxhash64("id").alias("spread"), F.lit(None).cast("string").alias("verdict")
    )
    given = rules.where(F.length("host") > 0).select(
        F.lit(None).cast(asked.schema["id"].dataType).alias("id"),
        F.translate("host", UPPER, SMALL).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    ).withColumns({"key": host_key(F.col("host")), "spread": F.lit(0).cast("long")}).select(*asked.columns)
    cuts = _cuts(asked, ranges)
    placed = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType()), *asked.schema.fields])

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("key", "path", "spread")), strict=True)
            part = pa.array([bisect_right(cuts, row) for row in rows], pa.int32())
            kind = pa.array([1] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([part, kind, *batch.columns], placed.names)

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [(bisect_right(cuts, (x, "", -(2**63))), bisect_left(cuts, (x + LAST, "", 0))) for x in batch.column("key").to_pylist()]
            take = pa.array([at for at, (low, high) in enumerate(spans) for _ in range(low, high + 1)], pa.int64())
            part = pa.array([p for low, high in spans for p in range(low, high + 1)], pa.int32())
            kind = pa.array([0] * len(part), pa.int32())
            yield pa.RecordBatch.from_arrays([part, kind, *batch.take(take).columns], placed.names)

    together = asked.mapInArrow(place_urls, placed).unionByName(given.mapInArrow(place_rules, placed))
    sorted_rows = together.repartitionById(ranges, "part").sortWithinPartitions("key", "kind", "path", "spread")
    out = T.StructType([T.StructField(key, urls.schema[key].dataType), *(T.StructField(x, T.StringType()) for x in ("host", "path", "rule", "verdict"))])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = OpenHosts()
        for batch in batches:
            take, found = [], []
            columns = (batch.column(name).to_pylist() for name in ("kind", "key", "host", "path", "verdict"))
            for at, (kind, host_key_, host, path, verdict) in enumerate(zip(*columns, strict=True)):
                stack.close(host_key_)
                if kind == 0:
                    stack.open(host_key_, host, path, verdict)
                else:
                    take.append(at)
                    found.append(stack.longest(path) or (None, default))
            kept = batch.take(pa.array(take, pa.int64()))
            rule, verdict = ([x[at] for x in found] for at in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(name) for name in ("id", "host", "path")), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], out.names
            )

    return sorted_rows.mapInArrow(sweep, out)


class OpenHosts:
    """The stack of rule hosts whose interval the sweep is in, innermost last."""

    def __init__(self) -> None:
        self.frames: list[tuple[str, str, dict[str, str]]] = []

    def close(self, key: str) -> None:
        """Drop the hosts whose interval ended before ``key``."""
        while self.frames and not key.startswith(self.frames[-1][0]):
            self.frames.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        if not self.frames or self.frames[-1][0] != key:
            self.frames.append((key, host, {}))
        paths = self.frames[-1][2]
        if paths.get(path) != "block":
            paths[path] = verdict

    def longest(self, path: str) -> tuple[str, str] | None:
        best, size = None, -1
        for _, host, paths in reversed(self.frames):
            # A host with few rules tries each, one with many looks its path's beginnings up.
            few = len(paths) <= len(path)
            for start in paths if few else (path[:n] for n in range(len(path) + 1)):
                if len(host) + len(start) > size and (path.startswith(start) if few else start in paths):
                    best, size = (host + start, paths[start]), len(host) + len(start)
        return best


def _cuts(asked: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """At most ``ranges - 1`` sort keys that split the rows about evenly."""
    rows = asked.count()
    if ranges < 2 or not rows:
        return []
    drawn = asked.select("key", "path", "spread").sample(min(1.0, DRAWN * ranges / rows), seed=11).limit(4 * DRAWN * ranges).collect()
    keys = sorted(tuple(row) for row in drawn)
    return sorted({keys[at * len(keys) // ranges] for at in range(1, ranges)}) if keys else []
