"""The saved offset: every change is appended, so a crash never leaves it unreadable.

Besides marks the log holds the runs begun: ``seq`` grows with every entry and is never used
again, not even after a reset, so it can name what a run writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.schemas import MARKS


def _log(spark: SparkSession, path: str) -> DataFrame:
    nothing = spark.range(0).select(*(F.lit(0).cast("long").alias(name) for name in MARKS.names))
    nothing.write.mode("ignore").parquet(path)  # only where there is no folder yet
    return spark.read.schema(MARKS).parquet(path)


def _latest(spark: SparkSession, path: str) -> tuple[int, int, int | None]:
    """The last entry's number, the mark, and the upper end of a run begun but not ended."""
    log = _log(spark, path)
    row = log.orderBy(F.desc("seq"), F.desc("offset_value")).first()
    return (row["seq"], row["offset_value"], row["upto"]) if row else (-1, 0, None)


def _append(spark: SparkSession, path: str, seq: int, offset: int, upto: int | None = None) -> None:
    row = spark.range(1).select(
        F.lit(seq).cast("long").alias("seq"),
        F.lit(offset).cast("long").alias("offset_value"),
        F.lit(upto).cast("long").alias("upto"),
    )
    row.coalesce(1).write.mode("append").parquet(path)


def read_mark(spark: SparkSession, path: str) -> int:
    """The offset below or at which everything has been handled; 0 at first."""
    return _latest(spark, path)[1]


def write_mark(spark: SparkSession, path: str, offset: int) -> None:
    _append(spark, path, _latest(spark, path)[0] + 1, offset)


def advance_mark(spark: SparkSession, path: str, offset: int) -> None:
    """Move the mark forward; never back, so that a repeated batch does no harm."""
    seq, reached, _ = _latest(spark, path)
    if offset > reached:
        _append(spark, path, seq + 1, offset)


def reset_mark(spark: SparkSession, path: str) -> None:
    write_mark(spark, path, 0)


def open_run(spark: SparkSession, path: str) -> tuple[int, int, int] | None:
    """``seq, mark, upto`` of the run that was begun and has not ended, if there is one."""
    seq, mark, upto = _latest(spark, path)
    return None if upto is None else (seq, mark, upto)


def begin_run(spark: SparkSession, path: str, upto: int) -> tuple[int, int, int]:
    """Note, before anything is scored, that the rows above the mark up to ``upto`` are taken."""
    seq, mark, _ = _latest(spark, path)
    _append(spark, path, seq + 1, mark, upto)
    return seq + 1, mark, upto
