"""The incremental job: new rows in, positives appended, mark moved on."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.sources.marks import advance_mark
from pagesieve.sources.results import Sink, as_sink

Job = Callable[[DataFrame], DataFrame]


def stream_rows(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of ``folder`` as a stream. Every new file is read, whatever its ids."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def handle_batch(rows: DataFrame, batch_id: int, job: Job, result: str | Sink, marks: str, query: str = "stream") -> None:
    """Score one batch, store its positives, then move the mark to its largest offset.

    The batch is read once: its rows, their largest offset and the positives are counted by
    observations while the positives are written, and the counts of both stages go to the table
    ``counts_folder(marks)``, one file per query and batch. The mark moves even if nothing was
    positive. A crash in between repeats the batch, which replaces its own partition of the
    result and its own counts, named by the query and the batch.
    """
    name = f"{query}-{batch_id}"
    seen, kept = Observation(f"rows-{uuid.uuid4().hex}"), Observation(f"kept-{uuid.uuid4().hex}")
    observed = rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.max("offset").alias("largest"))
    positives = job(observed).observe(kept, F.count(F.lit(1)).alias("n_rows"))
    as_sink(result)(positives, name)
    counts = {"n_rows": seen.get["n_rows"], "largest": seen.get["largest"], "n_positives": kept.get["n_rows"]}
    spark = rows.sparkSession
    row = spark.createDataFrame([(query, int(batch_id), counts["n_rows"], counts["n_positives"], counts["largest"])], COUNTS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{counts_folder(marks)}/{name}")
    if counts["largest"] is not None:
        advance_mark(spark, marks, counts["largest"])


#: One row per batch: rows read, positives stored, largest offset (null for an empty batch).
COUNTS = T.StructType(
    [T.StructField("query", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("batch", "n_rows", "n_positives", "largest")]
)


def counts_folder(marks: str) -> str:
    return f"{marks.rstrip('/')}-counts"


def read_counts(spark: SparkSession, marks: str) -> DataFrame:
    """The counts of every batch handled with these marks, as a table."""
    return spark.read.schema(COUNTS).parquet(f"{counts_folder(marks)}/*")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives the query of a checkpoint and keeps in it over restarts."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def run_incremental(rows: DataFrame, job: Job, result: str | Sink, marks: str, checkpoint: str) -> None:
    """Handle everything that is there, in batches, and stop; the next run resumes after it.

    A batch's number only counts within its checkpoint, so the query's id stands before it:
    queries with other checkpoints may share the result and never replace each other's batches.
    (One that reads the same files again, its checkpoint lost, stores their rows again.)
    """
    spark = rows.sparkSession
    query = (
        rows.writeStream.foreachBatch(
            lambda batch, batch_id: handle_batch(batch, batch_id, job, result, marks, query_id(spark, checkpoint))
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def add_frequencies(words: DataFrame, batch_id: int, folder: str, column: str = "words", query: str = "stream") -> None:
    """Write one batch's document frequencies (``word, df``: texts of the batch that hold the
    word) as its own delta, replacing what a repeated batch wrote before."""
    delta = words.select(F.explode(F.array_distinct(column)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    delta.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{query}-{batch_id}")


def read_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    """``word, df`` over all batches so far: the deltas summed, combined before the shuffle."""
    deltas = spark.read.schema("word string, df long").parquet(f"{folder.rstrip('/')}/*")
    return deltas.groupBy("word").agg(F.sum("df").alias("df"))


def run_frequencies(rows: DataFrame, words: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str) -> None:
    """Keep document frequencies of a stream up to date, a delta per batch (see ``add_frequencies``);
    ``words`` turns a batch into its word lists. Everything there is handled, then it stops."""
    spark = rows.sparkSession
    query = (
        rows.writeStream.foreachBatch(
            lambda batch, batch_id: add_frequencies(words(batch), batch_id, folder, "words", query_id(spark, checkpoint))
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
