"""What the operators of this folder share: Arrow batches, shared files, byte tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of one Arrow batch between the JVM and Python; they bound a task's memory.
BATCH_ROWS, BATCH_BYTES = 1000, "32m"

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts are long, and a batch is held whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string or binary column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def mapped(
    df: DataFrame,
    value: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
) -> DataFrame:
    """The columns ``keep`` and, computed in Python from the column ``value``, ``fields``.

    ``make`` runs once per task and gives the function from a batch of values to the new
    columns. Rows stay where they are: no shuffle. A kept column named like a new one is dropped.
    """
    small_batches(df.sparkSession)
    made = {field.name for field in fields}
    keep = [name for name in keep if name not in made]
    schema = T.StructType([*(df.schema[name] for name in keep), *fields])
    names = schema.names
    sent = df.select(*keep, F.col(value).alias("__value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            kept = [batch.column(at) for at in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, *work(batch.column(len(keep)))], names)

    return sent.mapInArrow(run, schema)


def filtered(df: DataFrame, value: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """The rows of ``df`` for whose ``value`` the function of ``make`` gives true; all columns stay."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            yield batch.filter(work(batch.column(value)))

    return df.mapInArrow(run, df.schema)


def new_file(folder: str, name: str):
    """A file system and a fresh path in ``folder``, a URI of any file system Arrow opens.

    Each attempt of a task writes under a name of its own; only those its committed rows list
    are ever read, so a repeated or lost attempt leaves nothing but an unread file.
    """
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}")
    store.create_dir(path, recursive=True)
    return store, f"{path.rstrip('/')}/{uuid.uuid4().hex}{name}"


def open_store(folder: str):
    """The file system of ``folder``."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}")[0]


def drawn(df: DataFrame, by: str, key: str, n: int, counts: dict, seed: int) -> DataFrame:
    """At most ``n`` rows of each value of ``by`` in ``counts`` (its rows), those whose ``key``
    hashes lowest, with their rank ``place``.

    Rows whose hash is too high to be among them by six standard deviations go before anything
    is shuffled, so that however many rows a value has, about ``n`` are ranked.
    """
    share = {value: min(1.0, (n + 6 * n**0.5 + 10) / count) for value, count in counts.items()}
    if not share:
        return df.limit(0).withColumn("place", F.lit(0))
    bounds = F.create_map(*(F.lit(x) for value, part in share.items() for x in (value, min(int(part * 2**64) - 2**63, 2**63 - 1))))
    low = df.withColumn("hash", F.xxhash64(F.lit(seed), key)).where(F.col("hash") <= F.try_element_at(bounds, F.col(by)))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("hash", key))
    return low.withColumn("place", rank).where(F.col("place") <= n).drop("hash")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
