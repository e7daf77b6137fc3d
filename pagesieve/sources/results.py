"""Where results go: tables of positives, scores, archived snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.functions.paths import archive_path, first_segment
from pagesieve.operators.skew import skew_join
from pagesieve.sources.files import place_of

Sink = Callable[[DataFrame, str], None]

# Column types of the result table in a database.
DATABASE_TYPES = {
    "wzmc": "VARCHAR(255)",
    "ym": "VARCHAR(255)",
    "yjym": "VARCHAR(255)",
    "url": "VARCHAR(255)",
    "nwdz": "VARCHAR(255)",
    "rksj": "DATETIME",
    "logits": "DOUBLE",
    "logits_main": "DOUBLE",
    "logits_sub": "DOUBLE",
}


def append_result(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_batch(rows: DataFrame, path: str, batch_id: int | str) -> None:
    """Write one batch into its own partition. Writing it again replaces it, so a batch repeated
    after a crash leaves no second copy. ``batch_id`` must name one batch of one writer."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def as_sink(result: str | Sink) -> Sink:
    """How a job stores a batch: a folder, or any function of the rows and the batch's name."""
    return result if callable(result) else lambda rows, batch: write_batch(rows, result, batch)


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``; name ``batch_id`` in it to see the batches."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_database(rows: DataFrame, table: str, options: Mapping[str, str]) -> None:
    """Append to a database table, created with the declared types where missing."""
    types = ", ".join(f"{name} {DATABASE_TYPES[name]}" for name in rows.columns if name in DATABASE_TYPES)
    (
        rows.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("createTableColumnTypes", types)
        .mode("append")
        .save()
    )


def write_scores_csv(scores: DataFrame, path: str) -> None:
    scores.write.option("header", True).csv(path)


def read_scores_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def with_bucket(df: DataFrame, path: str, buckets: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Add ``bucket``, looked up by the path's first segment; one not listed raises if strict."""
    pairs = [F.lit(part) for pair in buckets.items() for part in pair]
    segment = first_segment(F.col(path))
    bucket = F.try_element_at(F.create_map(*pairs), segment)
    if strict:
        missing = F.concat(F.lit("no bucket for "), segment)
        bucket = F.when(bucket.isNull() & F.col(path).isNotNull(), F.raise_error(missing)).otherwise(bucket)
    return df.withColumn("bucket", bucket)


def archived(positives: DataFrame, snapshots: DataFrame, root: str, day: Column, key: str) -> DataFrame:
    """``key, file_path, dst, dt, html`` of the positives' snapshots."""
    wanted = positives.select(key, "file_path")
    return skew_join(wanted, snapshots, "file_path", spread=[F.col(key)]).select(
        key,
        "file_path",
        archive_path(F.col("file_path"), root, day).alias("dst"),
        F.date_format(day, "yyyy-MM-dd").alias("dt"),
        "html",
    )


def write_archive(rows: DataFrame, path: str, run: str) -> None:
    """Archive as one table with a partition per day and run. A day's later runs add to it, a run
    that is repeated replaces what it wrote; ``run`` must name one run, as a batch's name does."""
    writer = rows.withColumn("run", F.lit(run)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run").parquet(path)


def copy_files(df: DataFrame, source: str, target: str) -> DataFrame:
    """Copy the file each row names, one by one inside the tasks; gives ``source, target, copied``.

    Paths are URIs of any file system Arrow opens. Copying again overwrites, so a repeated task
    does no harm; a file that is missing is reported and costs no other row its copy.
    """
    schema = T.StructType(
        [
            T.StructField("source", T.StringType()),
            T.StructField("target", T.StringType()),
            T.StructField("copied", T.BooleanType()),
        ]
    )

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def one(src: str, dst: str) -> bool:
            from_fs, from_path = place_of(src)
            to_fs, to_path = place_of(dst)
            to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
            try:
                fs.copy_files(from_path, to_path, from_fs, to_fs)
            except FileNotFoundError:
                return False
            return True

        for batch in batches:
            done = [one(*pair) for pair in zip(batch["source"], batch["target"], strict=True)]
            yield batch.assign(copied=done)

    pairs = df.select(F.col(source).alias("source"), F.col(target).alias("target"))
    return pairs.mapInPandas(copy, schema)
