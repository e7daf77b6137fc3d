"""Token counts by a separator scan over flat token files without an index.

Files hold the ids of many documents one after another, each closed by the end-of-document id.
They are cut into blocks of equal size that know nothing of each other: a block reports the
lengths between its separators and what is left at both ends, and a prefix scan over the blocks'
reports joins documents that cross blocks and numbers them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.bpe import Codec, read_ranks
from pagesieve.llm.common import as_bytes, new_file, open_store, shuffle_partitions, small_batches
from pagesieve.session import new_folder, shared_folder, stored

#: Bytes after which a task begins its next file; tokens of a block; blocks scanned together.
FILE_BYTES, BLOCK_TOKENS, GROUP_BLOCKS = 512 << 20, 1 << 20, 1024


def write_token_files(docs: DataFrame, path: str, pattern: str, separator: int, key: str = "doc_id", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the texts' ids as little-endian 16-bit integers; gives ``file, ordinal, key``.

    Every document is closed by ``separator``, which no text encodes to; vocabulary and separator
    must stay below 65,536. Null texts count as empty. The list is stored, so it names the files
    of the attempts that counted and no others.
    """
    small_batches(docs.sparkSession)
    folder = new_folder(docs.sparkSession, "tokens")
    listed = T.StructType([T.StructField("file", T.StringType()), T.StructField("ordinal", T.LongType()), docs.schema[key]])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        if max(ranks.values()) > 0xFFFF or not 0 <= separator <= 0xFFFF or separator in ranks.values():
            raise ValueError("ids and separator must fit 16 bits, and the separator must be free")
        codec, sink, size, ordinal, name = Codec(ranks, pattern), None, 0, 0, ""
        close = np.array([separator], "<u2")
        for batch in batches:
            files, ordinals = [], []
            for text in as_bytes(batch.column("text")):
                if sink is None:
                    store, name = new_file(folder, ".u16")
                    sink, size, ordinal = store.open_output_stream(name), 0, 0
                data = np.concatenate([codec.encode((text or b"").decode("utf-8", "replace")).astype("<u2"), close]).tobytes()
                sink.write(data)
                files.append(name)
                ordinals.append(ordinal)
                ordinal, size = ordinal + 1, size + len(data)
                if size >= file_bytes:
                    sink.close()
                    sink = None
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), batch.column(key)], listed.names)
        if sink is not None:
            sink.close()

    return stored(docs.select(key, "text").mapInArrow(write, listed), "token-list")


def file_blocks(files: DataFrame, block: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, start, count`` (in tokens) for the files the column ``file`` names."""
    root = shared_folder(files.sparkSession)
    sized = T.StructType([T.StructField("file", T.StringType()), T.StructField("tokens", T.LongType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = open_store(root)
        for batch in batches:
            names = batch.column("file").to_pylist()
            sizes = [info.size for info in store.get_file_info(names)]
            if any(size is None or size % 2 for size in sizes):
                raise ValueError("a token file is missing or cut inside an id")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([size // 2 for size in sizes], pa.int64())], sized.names)

    spans = files.select("file").mapInArrow(measure, sized).where("tokens > 0")
    last = F.floor((F.col("tokens") - 1) / block).cast("long")
    each = spans.select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    start = F.col("block") * block
    return each.select("file", "block", start.alias("start"), F.least(F.lit(block), F.col("tokens") - start).alias("count"))


def scan_blocks(blocks: DataFrame, separator: int) -> DataFrame:
    """``file, block, seps, head, tail, inner``: separators of a block, tokens before the first
    and after the last (all of them, as ``tail``, without one), and the lengths between."""
    root = shared_folder(blocks.sparkSession)
    long = T.LongType()
    report = T.StructType(
        [T.StructField("file", T.StringType()), *(T.StructField(x, long) for x in ("block", "seps", "head", "tail")), T.StructField("inner", T.ArrayType(T.IntegerType()))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = open_store(root)
        for batch in batches:
            for name, block, start, count in zip(*(batch.column(x).to_pylist() for x in ("file", "block", "start", "count")), strict=True):
                with store.open_input_file(name) as source:
                    source.seek(2 * start)
                    ids = np.frombuffer(source.read(2 * count), "<u2")
                if len(ids) != count:
                    raise ValueError(f"{name}: cut short")
                at = np.flatnonzero(ids == separator)
                head, tail = (int(at[0]), count - 1 - int(at[-1])) if len(at) else (0, count)
                columns = [[name], [block], [len(at)], [head], [tail]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.string() if x == [name] else pa.int64()) for x in columns] + [pa.array([np.diff(at) - 1], pa.list_(pa.int32()))], report.names
                )

    # A given number of partitions: the rows are small, the blocks are not, and one task must not get all.
    return blocks.repartition(shuffle_partitions(blocks.sparkSession), "file", "block").mapInArrow(scan, report)


def stitched(reports: DataFrame, group: int = GROUP_BLOCKS) -> DataFrame:
    """Add to every report ``first``, the number of the document its first separator closes, and
    ``carry``, that document's tokens in earlier blocks.

    The scan has two levels, blocks within groups of ``group`` and groups within their file, so
    that not even one file's reports all meet in a task: ``open`` tokens run on from the last
    separator of a stretch, and a stretch without one adds to what came before.
    """
    reports = reports.withColumn("group", F.floor(F.col("block") / group))
    inside = Window.partitionBy("file", "group").orderBy("block")
    before, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    local = reports.select(
        "*",
        F.coalesce(F.sum("seps").over(before), zero).alias("seps_before"),
        F.coalesce(F.sum("tail").over(before), zero).alias("tails_before"),
    ).withColumn("cut", F.last(F.when(F.col("seps") > 0, F.col("tails_before")), True).over(before))
    local = local.withColumn("open", F.col("tails_before") - F.coalesce("cut", zero))
    totals = reports.groupBy("file", "group").agg(F.sum("seps").alias("g_seps"), F.sum("tail").alias("all_tails"), F.max(F.when(F.col("seps") > 0, F.col("block"))).alias("last_block"))
    after = (
        reports.join(totals.select("file", "group", "last_block"), ["file", "group"])
        .where("block >= last_block")
        .groupBy("file", "group")
        .agg(F.sum("tail").alias("since"))
    )
    groups = totals.join(after, ["file", "group"], "left")
    across = Window.partitionBy("file").orderBy("group")
    g_before = across.rowsBetween(Window.unboundedPreceding, -1)
    has = F.col("g_seps") > 0
    groups = groups.select(
        "file",
        "group",
        F.coalesce(F.sum("g_seps").over(g_before), zero).alias("base"),
        F.coalesce(F.sum("all_tails").over(g_before), zero).alias("t_before"),
        # Where the count of tails begins again: behind a group with separators, ``since`` is open.
        F.last(F.when(has, F.col("since")), True).over(g_before).alias("since_last"),
        F.last(F.when(has, F.sum("all_tails").over(across.rowsBetween(Window.unboundedPreceding, 0))), True).over(g_before).alias("t_last"),
    )
    g_open = F.col("t_before") - F.coalesce("t_last", zero) + F.coalesce("since_last", zero)
    groups = groups.select("file", "group", "base", g_open.alias("g_open"))
    joined = local.join(groups, ["file", "group"])
    return joined.select(
        *reports.columns,
        (F.col("base") + F.col("seps_before")).alias("first"),
        (F.col("open") + F.when(F.col("cut").isNull(), F.col("g_open")).otherwise(zero)).alias("carry"),
    )


def count_tokens(files: DataFrame, separator: int, block: int = BLOCK_TOKENS, group: int = GROUP_BLOCKS) -> DataFrame:
    """``file, ordinal, n_tokens`` for every document of the files the column ``file`` names.

    Separators do not count. Tokens after a file's last separator are one more document; an
    empty file has none, two separators in a row enclose an empty one. Files named twice are
    counted twice.
    """
    # A block and its neighbours' ends are read by several branches: the files are scanned once.
    reports = stored(scan_blocks(file_blocks(files, block), separator), "blocks")
    whole = stitched(reports, group)
    closed = whole.where("seps > 0").select(
        "file",
        F.posexplode(F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner").cast("array<bigint>"))).alias("at", "n_tokens"),
        "first",
    )
    closed = closed.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens")
    ends = whole.groupBy("file").agg(F.max_by(F.struct("first", "seps", "carry", "tail"), "block").alias("e")).select("file", "e.*")
    left = F.col("tail") + F.when(F.col("seps") > 0, F.lit(0)).otherwise(F.col("carry"))
    unclosed = ends.select("file", (F.col("first") + F.col("seps")).alias("ordinal"), left.alias("n_tokens")).where("n_tokens > 0")
    return closed.unionByName(unclosed)


def document_tokens(docs: DataFrame, path: str, pattern: str, separator: int, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens`` of every document, counted in the flat files it is written to."""
    listed = write_token_files(docs, path, pattern, separator, key)
    counts = count_tokens(listed.select("file").distinct(), separator)
    return listed.join(counts, ["file", "ordinal"]).select(key, "n_tokens")
