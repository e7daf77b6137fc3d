"""The same job over a table that has no stream, such as one in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagesieve.sources.marks import begin_run, open_run, read_mark, write_mark
from pagesieve.sources.pages import incoming_rows
from pagesieve.sources.results import Sink, as_sink
from pagesieve.streaming.incremental import Job


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, without a pass of their own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def run_above_mark(table: DataFrame, job: Job, result: str | Sink, marks: str) -> int:
    """Score the rows above the saved mark, add the positives, move the mark; gives their number.

    The run's number and upper end are noted before anything is scored, so the mark never passes
    unread rows and a run that broke off is repeated as it was: same rows, same partition of the
    result, which it replaces. Numbers are never used again, so no run, not even one that begins
    at 0 after a reset, touches what another has stored.
    """
    spark = table.sparkSession
    begun = open_run(spark, marks)
    if begun is None:
        largest = incoming_rows(table, read_mark(spark, marks)).agg(F.max("offset")).first()[0]
        if largest is None:
            return 0
        begun = begin_run(spark, marks, largest)
    seq, mark, upto = begun
    fresh = incoming_rows(table, mark).where(F.col("offset") <= upto)
    positives, observation = counted(job(fresh), "positives")
    as_sink(result)(positives, f"table-{seq}")
    write_mark(spark, marks, upto)
    return observation.get["n_rows"]
